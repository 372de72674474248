"""Layout wrappers whose class or id has a word of what is not main text."""

import pytest

from rolecast.llm.html_extract import main_text

BODY = "<p>A paragraph of the article that is long enough.</p><p>Another one, which is long as well.</p>"
TEXT = "A paragraph of the article that is long enough.\nAnother one, which is long as well."
COMMENTS = "<section id='comments'><article><p>A reader's comment that is much longer than the whole of the article above, word by word by word by word by word by word.</p></article></section>"


@pytest.mark.parametrize("wrapper", ["class='content with-sidebar'", "class='has-comments'", "class='fixed-header'", "id=page-with-sidebar", "class='layout sidebar'", "class='sidebar'"])
@pytest.mark.parametrize("tag", ["<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_wrapper_of_the_text_stays(wrapper, tag):
    page = f"<body><nav>menu</nav><div {wrapper}>{tag.format(BODY)}<div class='sidebar'><p>links and more</p></div></div><footer>f</footer></body>"
    assert main_text(page) == TEXT


@pytest.mark.parametrize(
    "page",
    [
        f"<main><div class='content with-sidebar'>{BODY}<div class='related'><p>See this</p></div></div></main>",
        f"<div class='no-banner'><div class='has-widgets with-sidebar'><article>{BODY}</article></div></div>",
        f"<article>{BODY}</article>{COMMENTS}",
        f"<div class='has-comments'><article>{BODY}</article>{COMMENTS}</div>",
        f"<div>{BODY}</div><div id='comments'><p>{'a long reader comment ' * 20}</p></div>",
        f"<div class='sidebar'><article><p>teaser</p></article></div><article>{BODY}</article>",
        f"<p>teaser</p><div class='content with-sidebar'><article>{BODY}</article></div>",
        f"<div class='fixed-header' style='display:none'><article><p>{'hidden ' * 99}</p></article></div><article>{BODY}</article>",
    ],
)
def test_what_is_around_the_text_goes(page):
    assert main_text(page) == TEXT
