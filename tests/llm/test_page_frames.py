"""Names of wrappers do not take the content away."""

from spendloom.llm import html_text

TEXT = "<p>The whole text of the page, with some words in it.</p><p>And a second paragraph of it.</p>"
PLAIN = "The whole text of the page, with some words in it.\nAnd a second paragraph of it."


def test_named_wrappers_keep_their_content():
    for name in ("layout has-sidebar", "page hasSidebar", "search", "social-page", "with-comments", "no-ads", "widget", "skip-target", "related promo"):
        for inner in (f"<article>{TEXT}</article>", f"<main>{TEXT}</main>", TEXT):
            for source in (f'<div class="{name}">{inner}</div>', f'<nav>a b c</nav><div id="{name}"><div>{inner}</div><aside>more</aside></div><footer>end</footer>'):
                assert html_text.main_text(source, {}) == PLAIN, source


def test_named_blocks_still_go():
    assert html_text.main_text(f'<article>{TEXT}<div class="share">Tell your friends</div></article>', {}) == PLAIN
    assert html_text.main_text(f'<article>{TEXT}</article><div class="comments"><article class="comment"><p>I like it</p></article></div>', {}) == PLAIN
    assert html_text.main_text(f'<div>{TEXT}</div><div class="newsletter"><p>Get our mail every day</p></div>', {}) == PLAIN
    assert html_text.main_text(f'<div class="layout has-sidebar"><div class="sidebar"><p>Other things</p></div><article>{TEXT}</article></div>', {}) == PLAIN


def test_script_is_no_frame():
    code = "<script>" + "var a = 1; " * 100 + "</script>"
    assert html_text.main_text(f'<div class="notice">{code}<p>A notice</p></div><div>{TEXT}</div>', {}) == PLAIN
