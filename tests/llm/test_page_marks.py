"""Pages whose marks do not name the article, and short blocks behind furniture."""

import time

import pytest

from flowgauge.llm import line_blocks
from flowgauge.llm.line_blocks import main_text

LONG = "A paragraph of the story that is told here at some length, with more words than any of the cards beside it."
STORY = " ".join([LONG] * 4)
CARDS = "".join(f"<article><h3>Card {at}</h3><p>Read on.</p></article><nav>more</nav>" for at in range(40))
POEM = [f"line {at} of a poem" for at in range(60)]


@pytest.mark.parametrize("page", [f"<div><p>{STORY}</p><p>{LONG}</p></div>{{}}".format(cards) for cards in (CARDS, CARDS.replace("<nav>more</nav>", ""))])
def test_a_story_beside_marked_cards_is_kept(page):
    assert f"{STORY} {LONG}" in main_text(page)


def test_marked_short_lines_outweigh_one_long_unmarked_line():
    page = f"<article>{''.join(f'<p>{line}</p>' for line in POEM)}</article><div><p>{LONG}</p></div>"
    assert main_text(page) == " ".join(POEM)


def test_a_short_closing_behind_furniture_is_kept():
    page = f"<div><p>{LONG}</p><form>Sign up</form><p>The end.</p></div><footer>Foot</footer>"
    assert main_text(page) == f"{LONG} The end."
    assert main_text("<div><p>Too short</p></div><form>Sign up</form><p>to be text.</p>") == ""


WORDS = "Some words of an article that go on for a while, as articles do, so that they fill a window of lines."


def test_tags_end_where_html_ends_them():
    for attributes in ("title=it's", 'class="a""', "a='b\"' c=\"'\"", 'x=y"z', "href=/a?b=c'd", "a = 'b>c'", "=x", "'", "a/"):
        page = f"<html><article><p {attributes}>{WORDS}</p><p>And {attributes and 'more'}.</p></article></html>"
        assert line_blocks.main_text(page) == f"{WORDS} And more.", attributes


def test_signs_that_begin_no_tag_are_text():
    page = f"<article><p>{WORDS} 1 < 2 <3 </3 a<b</p><!-- <p>no</p> --><p>x <!doctype y> z</p></article>"
    assert line_blocks.main_text(page).startswith(f"{WORDS} 1 < 2 <3 </3 a")
    assert line_blocks.main_text(f"<article><p>{WORDS}</p><!-- never closed <p>no") == WORDS
    assert line_blocks.main_text(f"<article><p>{WORDS}</p><p a='never closed>no") == WORDS


def test_formulas_and_sections_with_odd_names_stay():
    page = f"<article><p>{WORDS} <math><mi>a</mi><mo>+</mo><mi>b</mi></math>.</p><section id=search><h2>Search</h2><p>How it is done.</p></section>"
    assert line_blocks.main_text(page + "<section id=comments><p>I agree.</p></section></article>") == f"{WORDS} a+b. Search How it is done."


def test_malformed_pages_take_time_in_proportion():
    for part in ("<a ", "<a b='", "<div>", "</x>", "<div></x>", "<div><p>", "<!--", "<", "<p a=", "<p =", "<p a  ", "&", "<script>", "<p class=advertadvert"):
        started = time.process_time()
        line_blocks.main_text(part * (300_000 // len(part)))
        assert time.process_time() - started < 10, part
