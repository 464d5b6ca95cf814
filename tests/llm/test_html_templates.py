"""Template removal: counts over differing bodies decide; lists, tables and harmless class names of an article stay."""

from ledgerlake.llm import html_extract


def _extract(spark, pages):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", html) for i, (host, html) in enumerate(pages)], "page_id long, url string, html string")
    return [r["text"] for r in html_extract.extract(df).orderBy("page_id").collect()]


STORY = "<article><h1>Head</h1><p>The same story stands on every page of this host.</p><ul><li>one</li><li>two</li></ul><table><tr><td>a</td><td>b</td></tr></table></article>"
STORY_TEXT = "Head\nThe same story stands on every page of this host.\none\ntwo\na\nb"


def test_a_copied_story_is_one_body(spark):
    """Page numbers make the pages differ; the story's list and table recur on all of them and stay."""
    got = _extract(spark, [("a.com", f"<body>{STORY}<div>Page {i}</div>") for i in range(8)])
    assert got == [f"{STORY_TEXT}\nPage {i}" for i in range(8)]


def test_the_same_list_beside_many_bodies_is_a_template(spark):
    page = "<body><article><p>Body number {0} of a story with words of its own.</p><ul><li>Print</li><li>Send</li></ul></article>"
    assert _extract(spark, [("a.com", page.format(i)) for i in range(8)]) == [f"Body number {i} of a story with words of its own." for i in range(8)]


def test_items_alone_are_no_template(spark):
    page = "<body><p>Question number {0} has some words.</p><ul><li>Yes</li><li>Only {0}</li></ul>"
    assert _extract(spark, [("a.com", page.format(i)) for i in range(8)]) == [f"Question number {i} has some words.\nYes\nOnly {i}" for i in range(8)]


def test_whole_class_names_only(spark):
    page = "<article><h1>H</h1><div class='notice-board'><p>Body {0}</p></div><div class='x related-work'><p>More {0}</p></div><div id='ad-hoc'>End {0}</div><div class='x notice'>no</div><div id=ad>no</div></article>"
    assert _extract(spark, [("a.com", page.format(i)) for i in range(3)]) == [f"H\nBody {i}\nMore {i}\nEnd {i}" for i in range(3)]


def test_only_counts_tell_the_template(spark):
    """No article, no class: the site's boxes recur beside many bodies. On a host with four pages nothing recurs enough."""
    page = "<body><div>Welcome to our site</div><div>Some text of page {0}, which is in a box like the rest.</div><div><div>Call us</div><div class='ad'>advert {0}</div>or write</div>"
    text = "Some text of page {0}, which is in a box like the rest."
    got = _extract(spark, [("a.com", page.format(i)) for i in range(6)] + [("b.com", page.format(i)) for i in range(4)])
    assert got == [text.format(i) for i in range(6)] + [f"Welcome to our site\n{text.format(i)}\nCall us\nor write" for i in range(4)]
