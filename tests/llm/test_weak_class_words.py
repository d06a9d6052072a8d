"""Class words must not outweigh the text of a page."""

import pytest
from conftest import SMALL

from rillflow.llm.op05_html import main_text
from rillflow.llm.util import table

P = "The river rises in the hills above the town and runs for many miles through woods and fields before it meets the sea, as it has done for longer than anybody in the valley can remember. " * 2
NAMES = "social-science share-price market-respond ad-hoc-report consent-decree related-work popup-book promo-video toolbar-guide comment-piece banner-year notice-board menu-planning".split()
TEXT = f"{P.strip()}\n\n{P.strip()}"


@pytest.mark.parametrize("name", NAMES)
def test_articles_named_like_parts(name):
    assert main_text(f'<body><div class="top"><p>Home page</p></div><div class="{name}"><p>{P}</p><p>{P}</p></div></body>') == TEXT


def test_a_title_beside_a_notice():
    assert main_text(f'<h1>T</h1><div class="public-notice"><p>{P}</p><p>{P}</p></div>') == f"T\n\n{TEXT}"


def test_what_is_no_article_stays_out():
    links = "".join(f"<li><a href=/{k}>A longer line about something that is sold or said elsewhere, number {k}</a></li>" for k in range(30))
    reply = f"<div class=comment><p>{P}</p></div>" * 9
    page = f"<div class='promo-box'><p>{P[:150]}</p></div><div class='text'><p>{P}</p><p>{P}</p></div><div id=comments>{reply}</div><div class='related-posts'><ul>{links}</ul></div>"
    assert main_text(page) == TEXT
    # also where the article itself is named like a part
    assert main_text(page.replace("class='text'", "class='share-price'")) == TEXT
    assert main_text(page.replace("class='text'", "class='menu-planning'").replace("<div id=comments>", "<p>Home</p><div id=comments>")) == TEXT
    assert main_text(f"<p>Home</p><div class='related-posts'><ul>{links}</ul></div>") == "Home"


def test_names_inside_names():
    assert main_text(f'<p>Home</p><div class="banner-year"><div class="notice-board"><p>{P}</p><div class="share"><a href=/x>Share</a></div><p>{P}</p></div></div>') == TEXT
    deep = "<div class=notice>" * 3000 + f"<p>{P}</p>" + "</div>" * 3000
    assert main_text(f"<p>Home</p>{deep}") in ("Home", P.strip())


def test_pages_of_the_table_are_found_as_before(spark):
    for r in table(spark, SMALL, "pages").limit(60).collect():
        assert main_text(r.html)
