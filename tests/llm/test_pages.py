"""Pages that are built badly: open quotes, forms around the article, tags that never close."""

import time

import pytest

from logwarden.llm.html_tree import main_text

PROSE = "A long paragraph, with commas, and words that go on for a while, as they do."
ARTICLE = f"<p>{PROSE}</p>" * 4
TEXT = "\n".join([PROSE] * 4)


@pytest.mark.parametrize("page", [
    "<a " * 10**6 + "'", "<a \"> \"" * 10**5, "<a x=\"1>" * 10**5, "<!--" * 10**5, "<b>" * 50_000 + "</i>" * 50_000, "<a x='" * 10**5 + ">"])
def test_bad_pages_take_linear_time(page):
    start = time.time()
    main_text(page)
    assert time.time() - start < 30  # seconds, on a slow machine; in proportion to the square these took minutes to hours


def test_open_quote_ends_with_its_tag():
    assert main_text(f"<div><p title=\"x>{PROSE}</p>{ARTICLE}</div>") == "\n".join([PROSE] * 5)
    assert main_text(f"<div><p title='it > is'>{PROSE}</p>{ARTICLE}</div>") == "\n".join([PROSE] * 5)


def test_form_around_the_page():
    assert main_text(f"<body><form id=aspnetForm><div class=post><input name=q>{ARTICLE}</div></form></body>") == TEXT
    assert main_text(f"<body><form><label>Search</label></form><form><article>{ARTICLE}</article></form></body>") == TEXT
    # A form beside the article goes, with what it says.
    assert main_text(f"<body><form><p>{PROSE}</p><input></form><div>{ARTICLE}</div></body>") == TEXT
