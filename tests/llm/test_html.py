"""op10: pages whose marks are misleading, and built pages against the story put into them."""

import random

import pytest

from ledgerflow.llm import htmltext

STORY = "The story is here, and it goes on for a while without a link in it."


@pytest.mark.parametrize("page", [
    f'<div class="layout has-sidebar"><article><p>{STORY}</p></article></div>',
    f'<div class="content no-comments"><article><p>{STORY}</p></article></div>',
    f'<div class="page-with-banner"><article><p>{STORY}</p></article></div>',
    f'<div id="social-science"><article><p>{STORY}</p></article></div>',
    f'<article><section class="related-work"><p>{STORY}</p></section></article>',
    f'<article><section class="related"><p>{STORY}</p></section></article>',
    f'<div class="sidebar"><main><p>{STORY}</p></main></div>',
    f'<form id="page"><div><p>{STORY}</p></div></form>',
    f'<article><p>{STORY}</p><div class="comment-list"><article><p>First!</p></article></div></article>',
    f'<article><p>{STORY}</p></article><div class="site-footer"><p>{STORY * 9}</p></div>',
    f'<article><p>{STORY}</p><span><div class="ad">Buy</span></article>',
    f'<main><p>{STORY}</main><div class="social-links"><a>x</a><a>y</a></div>',
])
def test_marks_do_not_lose_the_article(page):
    assert htmltext.main_text(page) == STORY


def test_a_teaser_is_not_the_article():
    body = "".join(f"<p>{STORY} {i}</p>" for i in range(8))
    got = htmltext.main_text(f"<article><p>Read this</p></article><div>{body}</div>").split("\n")
    assert [f"{STORY} {i}" for i in range(8)] == [t for t in got if t != "Read this"]


def test_comments_longer_than_the_article_stay_out():
    page = f'<div><p>{STORY}</p></div><section class="comments">{"".join(f"<p>{STORY} {i}</p>" for i in range(30))}</section>'
    assert htmltext.main_text(page) == STORY


def test_built_pages_without_article_tags():
    rng = random.Random(5)
    words = "river stone lamp winter market letter garden silver morning harbour".split()
    boilerplate = ['<ul class="main-nav"><li><a>Home</a></li><li><a>News</a></li></ul>', "<nav><a>Top</a></nav>",
                   '<div class="cookie-banner"><p>We use cookies on this site, more than a few of them.</p></div>',
                   "<script>var story = 1;</script>", '<div id="sidebar"><p>Another story that is not this one.</p></div>',
                   "<div>" + "".join(f"<span><a>l{i}</a></span>" for i in range(12)) + "</div>",
                   '<form><label>Mail</label><input><button>Go</button></form>', '<p hidden>Not shown at all to anybody.</p>']
    for _ in range(200):
        story = [" ".join(rng.choices(words, k=rng.randint(25, 40))) for _ in range(rng.randint(4, 12))]
        before, after = (rng.choices(boilerplate, k=rng.randint(0, 4)) for _ in range(2))
        page = "<html><body>" + "".join(before) + "<div>" + "".join(
            f"<p>{p.replace(' ', chr(10) + ' ', 2)}</p>" for p in story) + "</div>" + "".join(after) + "</body></html>"
        assert htmltext.main_text(page) == "\n".join(story)


def test_unclosed_tags_in_linear_time():
    assert len(htmltext.main_text("<p><b>" * 20_000 + STORY + "</i>" * 100_000)) == len(STORY)
