"""Everyday layouts around one article: all of it is kept, and nothing else."""

import time

import pytest

from monthstar.llm.pages import main_texts

FIRST = "The committee met on Tuesday to talk about the new bridge over the river and what it will cost the town."
SECOND = "Several members asked for another report before the end of the year, and the mayor agreed to send one."
BODY = f"<h1>A new bridge</h1><p>{FIRST}</p><p>{SECOND}</p>"
TEXT = f"A new bridge\n{FIRST}\n{SECOND}"
MENU = '<ul class="nav"><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li></ul>'
SIDE = '<aside><h3>More</h3><ul><li><a href="/1">One story</a></li><li><a href="/2">Two story</a></li></ul></aside>'
FOOT = '<footer><p>All rights reserved by the paper and its owners, who may be reached by mail.</p></footer>'
COMMENTS = '<p>I was there and it was not like this at all, the mayor said nothing of the kind to anybody in the room.</p>'


@pytest.mark.parametrize(
    "page",
    [
        f"{MENU}<article>{BODY}</article>{FOOT}",
        f'<div class="site has-sidebar">{MENU}<article>{BODY}</article>{SIDE}</div>{FOOT}',
        f'<div class="layout sidebar">{MENU}<article>{BODY}</article>{SIDE}</div>',
        f'<article class="post comments-open">{BODY}</article>{FOOT}',
        f'<article id="post-12" class="post type-post no-sidebar with-banner">{BODY}</article>{SIDE}',
        f'<article><div class="entry-header"><h1>A new bridge</h1></div><p>{FIRST}</p><p>{SECOND}</p></article>',
        f'<article><header class="post-header"><h1>A new bridge</h1></header><p>{FIRST}</p><p>{SECOND}</p></article>{FOOT}',
        f'<article>{BODY}<section class="post-comments">{COMMENTS}</section></article>',
        f'<article>{BODY}<div class="related-posts">{COMMENTS}</div></article>{FOOT}',
        f'<article>{BODY}<div class="ad-slot">{COMMENTS}</div><div class="newsletter">{COMMENTS}</div></article>',
        f'<article>{BODY}</article><section id="comments">{COMMENTS}<article>{COMMENTS}</article></section>',
        f'<article>{BODY}</article><aside class="sidebar"><article>{COMMENTS}</article></aside>',
        f'<form id="page"><header class="site-header">{MENU}</header><main>{BODY}</main>{FOOT}</form>',
        f'<div class="modal-open widget"><main class="content navigation-closed">{BODY}</main></div>',
        f'<div class="page-header"><p>{COMMENTS}</p></div><article>{BODY}</article><div class="site-footer">{COMMENTS}</div>',
        f'<article>{BODY.replace("the new bridge", """the <a title="x > y" href=/b>new bridge</a>""")}</article>',
        f"<article>{BODY.replace('the new bridge', '''<a title='a > b' data-x=it's>the new bridge</a>''')}</article>{FOOT}",
        f'<div role="navigation">{MENU}</div><div class="cookie-banner">{COMMENTS}</div><main><article>{BODY}</article></main>',
    ],
)
def test_the_article_is_kept_whole_and_alone(page):
    assert main_texts([f"<!doctype html><html><body>{page}</body></html>"]) == [TEXT]


@pytest.mark.parametrize("unit", ["<a ", "<svg ", "<p title='", '<a href="x', "<", "<!", "<!--", "</", "&amp"])
def test_a_megabyte_of_broken_tags_is_read(unit):
    began = time.process_time()
    main_texts([unit * (1_000_000 // len(unit))])
    assert time.process_time() - began < 5
