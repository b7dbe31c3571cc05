"""The window sums decide on doubtful lines; pages without articles; comments without a class."""

from rollbook.llm import html_text

BODY = "<p>" + "words of the article " * 15 + "</p>"
TEXT = ("words of the article " * 15).strip()
MENU = "<ul class='menu'>" + "<li>Home</li><li>News</li><li>About</li><li>Contact</li><li>Help</li><li>More</li>" + "</ul>"


def test_words_of_a_class_never_drop_article_text_by_themselves():
    page = ('<article><p>a</p><section class="related-work"><p>b</p></section><p class="share-price">c</p>'
            '<div class="search-algorithms"><p>d</p></div></article>')
    assert html_text.main_text(page) == "a\nb\nc\nd"
    for mark in ("ad", "ad-box", "share-buttons", "related-posts", "comments", "comment-list", "ad-728-90", "newsletter-signup", "promo banner"):
        assert html_text.main_text(f"<article><p>a</p><div class='{mark}'><p>x</p></div><p>b</p></article>") == "a\nb", mark


def test_surge_and_dive_decide_on_doubtful_lines(monkeypatch):
    doubtful = "<div class='related-work'><p>See the other studies.</p></div>"
    amid, apart = f"<div>{BODY}{doubtful}{BODY}</div>{MENU}", f"<div>{BODY}{BODY}</div>{MENU}{doubtful}"
    assert html_text.main_text(amid) == f"{TEXT}\nSee the other studies.\n{TEXT}"
    assert html_text.main_text(apart) == f"{TEXT}\n{TEXT}"  # the windows around it hold menu lines alone
    # without the windows one of the two goes wrong, whichever way doubt is settled
    monkeypatch.setattr(html_text, "_dense", lambda weights, full: [True] * len(weights))
    assert html_text.main_text(apart) != f"{TEXT}\n{TEXT}"
    monkeypatch.setattr(html_text, "_dense", lambda weights, full: list(full))
    assert html_text.main_text(amid) != f"{TEXT}\nSee the other studies.\n{TEXT}"


def test_no_threshold_drops_plain_lines():
    page = f"<div>{BODY * 6}</div>{MENU}<p>A short close.</p>"
    assert html_text.main_text(page).endswith("\nA short close.") and html_text.main_text(page).count(TEXT) == 6


def test_comments_without_a_class_end_an_article_without_an_element():
    page = f"<h1>Title</h1>{BODY}<h3>3 Comments</h3><ul><li>Bob: nice</li><li>Eve: no</li></ul><p>me too</p>"
    assert html_text.main_text(page) == f"Title\n{TEXT}"
    assert html_text.main_text(f"<h1>Comments on a treaty</h1>{BODY}") == f"Comments on a treaty\n{TEXT}"
    inside = f"<article><h2>Responses</h2>{BODY}</article>"
    assert html_text.main_text(inside) == f"Responses\n{TEXT}"
