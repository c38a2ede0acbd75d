"""Names of wrappers, articles and sections that are in part about page furniture don't cost their text."""

import random
import re

import pytest

from meshloom.llm import html

BODY = " ".join(["Plain words follow each other in this long block of text and end only here."] * 3)
REST = "<nav><a href=/>Home</a> <a href=/n>News</a></nav>", "<footer>Imprint and more <a href=/c>Contact</a></footer>"
TEXT = f"<h1>Title words of the page</h1><p>{BODY}</p><p>Second {BODY}</p><p>Brief.</p>"
WANT = f"Title words of the page {BODY} Second {BODY} Brief."


@pytest.mark.parametrize("wrapped", [
    '<div class="with-sidebar"><article>{}</article></div>', '<div id="page" class="no-sidebar"><main>{}</main></div>', '<div class="content"><section class="post tag-history">{}</section></div>',
    '<article class="post comments-open tag-history">{}</article>', '<article class="post comment-status-open">{}</article>', '<form id="aspnetForm"><div class="content">{}</div></form>',
    '<div class="layout sidebar"><article>{}</article></div>', '<div class="search-results-off"><div>{}</div></div>', '<main class="has-related">{}</main>',
])
def test_wrappers_and_articles_with_such_names_keep_their_text(wrapped):
    page = f"<body>{REST[0]}{wrapped.format(TEXT)}{REST[1]}</body>"
    assert html.main_text(page) == WANT
    assert html.main_text(f"<body>{wrapped.format(REST[0] + TEXT + REST[1])}</body>") == WANT


@pytest.mark.parametrize("named", ['class="share-price"', 'class="related-work"', 'id="reply-to-critics"', 'class="login-problems"'])
def test_sections_of_an_article_keep_their_text(named):
    page = f"<body>{REST[0]}<article>{TEXT}<section {named}><h2>Section head</h2><p>Third {BODY}</p></section><p>Last {BODY}</p></article>{REST[1]}</body>"
    assert html.main_text(page) == f"{WANT} Section head Third {BODY} Last {BODY}"


@pytest.mark.parametrize("noise", ['<div class="share-buttons"><a href=/s>Share this</a></div>', '<div class="related-posts"><p>Read on elsewhere</p></div>', '<div id="comments" class="comment-list"><p>A reader has this to say about the whole of the article, and at some length too.</p></div>', '<div class="cookie-notice">We use cookies here</div>'])
def test_furniture_goes_wherever_it_stands(noise):
    for page in (f"<article>{TEXT}{noise}</article>", f"<article>{TEXT}</article>{noise}", f'<div class="no-sidebar">{noise}<article>{TEXT}</article></div>'):
        assert html.main_text(f"<body>{REST[0]}{page}{REST[1]}</body>") == WANT


def test_many_comments_are_no_wrapper():
    readers = "".join(f"<div><b>Name</b><p>Reader {k} says {BODY}</p></div>" for k in range(9))
    assert html.main_text(f'<body>{REST[0]}<article>{TEXT}</article><div id="comments">{readers}</div>{REST[1]}</body>') == WANT


def test_strength_is_the_share_of_a_name():
    told = {"comment-list": 1, "share-price": 0.5, "story": 0, "post comment-status-open": 1 / 3, "adsBox": 1, "": 0, "related_work x1": 0.5, "content": 0}
    assert {k: html.name_strength(k) for k in told} == pytest.approx(told)


def test_pages_whose_names_are_drawn_at_random():
    """The share of the article's words that stay, and of article in what stays, with a random part of a furniture name on every element of unseen pages."""
    kept = lost = false = 0
    for seed in range(7000, 7150):
        r = random.Random(seed)
        page = re.sub(r"<(div|section|article|main|ul)>", lambda m: f'<{m[1]} class="{"".join(r.choices("bdgkz", k=5))}-{r.choice(html._FURNITURE)}">', html.labelled_page(seed))
        text = html.main_text(page).split()
        good = sum(w[0] == "m" for w in text)
        kept, false, lost = kept + good, false + len(text) - good, lost + len(re.findall(r"(?<![a-z/<])m[aeiloprst]+(?=[ <])", page)) - good
    print(f"kept {kept / (kept + lost):.4f} clean {kept / (kept + false):.4f}")
    assert kept > 0.97 * (kept + lost) and false < 0.03 * kept
