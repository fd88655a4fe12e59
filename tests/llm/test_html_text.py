import random

import pytest
from dqloom.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var t="</p>";</script></head><body><nav><ul><li><a href=/x>Menu</a></ul></nav>
<!-- c --><div class="ad">Buy this now.</div><article><h1>Big  news &amp; more</h1><p><b>First <i>line</i>.<br><p>Second
 line&nbsp;here.<p>Caf&eacute; x&lt;y</article><footer>&copy; site</footer>"""


@pytest.fixture(scope="module")
def model():
    return H.train(H._built_in())


def test_main_text(model):
    assert H.main_text(PAGE, model) == "Big news & more\n\nFirst line.\n\nSecond line here.\n\nCafé x<y"
    assert H.main_text(None, model) == H.main_text("", model) == H.main_text("<", model) == ""
    assert H.main_text("<html><nav><a href=x>only menu</a></nav></html>", model) == ""


def test_odd_markup_never_fails(model):
    for html in ("<![if x]><p>a", "<p>" * 3000 + "deep", "<b>" * 3000 + "x", "</p></div>", "<p>&#0;&#x110000;&bogus;", "\x00<p>", "<script>never closed", "<!-- never closed"):
        H.main_text(html, model)


def test_held_out_blocks_of_built_in_pages(model):
    rng = random.Random(4)
    pages = H._built_in(80)[40:]
    words = " ".join(b.text for h in pages for b in H.blocks(h)).split()
    wrong = total = 0
    for html in pages:
        for found, labels in H.variants(html, words, rng):
            total += len(labels)
            wrong += sum(a != b for a, b in zip(model.decode(H.features(found)), labels, strict=True))
    assert wrong <= 0.02 * total


def test_viterbi_is_the_best_of_all_labellings(model):
    feats = H.features(H.blocks(PAGE))
    s = model.scores(feats)

    def score(y):
        return sum(s[i, k] for i, k in enumerate(y)) + sum(model.t[a, b] for a, b in zip(y, y[1:]))

    n = len(feats)
    best = max(score([(k >> i) & 1 for i in range(n)]) for k in range(1 << n))
    assert abs(score(model.decode(feats)) - best) < 1e-9


def test_query(spark, tmp_path):
    rows = [(1, "u", PAGE), (2, None, None), (None, "v", ""), (1, "u", PAGE), (3, "w", PAGE.replace("article", "div"))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df.write.parquet(f"{tmp_path}/a/pages.parquet")
    df.limit(0).write.parquet(f"{tmp_path}/b/pages.parquet")
    got = H.op5(spark, f"{tmp_path}/a").collect()
    assert sorted((str(r.page_id), r.n_chars, r.text) for r in got) == sorted((str(i), len(t), t) for i, t in [(1, got[0].text), (2, ""), (None, ""), (1, got[0].text), (3, next(r.text for r in got if r.page_id == 3))])
    assert next(r for r in got if r.page_id == 1).text.startswith("Big news & more\n\nFirst line.")
    assert H.op5(spark, f"{tmp_path}/b").count() == 0


def test_nothing_is_lost_behind_declarations_and_long_references():
    html = "<p>a<![x y]><p>b<![ endif]><p>c<![endif>d<p>e<![CDATA[ q > r ]]>f<p>&#" + "1" * 5000 + ";g<p>&#" + "0" * 5000 + "65;<p>end"
    assert [b.text for b in H.blocks(html)] == ["a", "b", "cd", "ef", "�g", "A", "end"]


def test_tags_of_any_depth_are_tracked():
    deep = "<div>" * 5000
    html = f"<article>{deep}<script>no</script><select><option>no</select><aside class=comments><p>away</aside><p>body</p></article>{'</div>' * 5000}<p>after"
    found = {b.text: b for b in H.blocks(html)}
    assert set(found) == {"away", "body", "after"}
    assert "aside" in found["away"].tags and "comments" in found["away"].names
    assert "article" in found["body"].tags and "aside" not in found["body"].tags and not found["body"].names
    assert "article" not in found["after"].tags
    inside = H.blocks(f"<article><div>{deep}{'</div>' * 5000}<p>still here</div></article>")
    assert "article" in inside[0].tags


def test_few_marked_pages_among_many_are_all_found(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(H, "train", seen.append)
    pages = spark.range(5000).selectExpr("id as page_id", "if(id % 1000 = 7, concat('<article><p>text ', id, '</article>'), '<p>no mark') as html")
    H.fit(pages)
    assert sorted(seen[0]) == sorted(f"<article><p>text {i}</article>" for i in range(7, 5000, 1000))


def test_comments_end_as_in_browsers():
    texts = lambda html: [b.text for b in H.blocks(html)]
    assert texts("<p>a</p><!-- unclosed <p>b") == ["a"]
    assert texts("<p>a</p><!--> <p>b</p><!---> <p>c</p><!-- x --!><p>d</p><!-- y > --><p>e</p>") == ["a", "b", "c", "d", "e"]


@pytest.mark.parametrize(
    "html, want",
    [
        ("<html><head><title>T</title><body><article><h1>H</h1><p>one</article>", ["H", "one"]),
        ("<head><title>T</title><p>one<p>two", ["one", "two"]),
        ("<head><meta charset=x><title>T</title>plain text", ["plain text"]),
        ("<p>a</p><button>Go<p>b</p><p>c</p>", ["a", "b", "c"]),
        ("<p>a</p><button><div>Go</div></button><p>b</p><button>More</button>c", ["a", "b", "c"]),
        ("<p>a</p><select><option>1<option>2<p>b</p>", ["a", "b"]),
        ("<p>a</p><select><option>1</option></select>b<p>c", ["a", "b", "c"]),
        ("<p>a <object>b</object> <video>c</p><p>d</p>", ["a b c", "d"]),
        ("<p>a</p><svg><title>t</title><text>no</text><p>b</p><svg><g>no</g></svg><p>c", ["a", "b", "c"]),
        ("<p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> be a number.</p>", ["Let x=1 be a number."]),
        ("<p>Let <math><mi>x</mi><p>next</p>", ["Let x", "next"]),
        ("<p>a<iframe><p>no</iframe><p>b<textarea><p>no</textarea><p>c", ["a", "b", "c"]),
    ],
)
def test_left_out_end_tags_lose_nothing(html, want):
    assert [b.text for b in H.blocks(html)] == want


def test_pages_without_end_of_head_and_very_long_ones(model):
    body = "".join(f"<p>Sentence number {i} of the story goes on, and on." for i in range(20000))
    html = f"<html><head><title>T</title><body><nav><a href=x>Menu</a></nav><article>{body}</article>"
    assert H.main_text(html, model) == "\n\n".join(f"Sentence number {i} of the story goes on, and on." for i in range(20000))


def test_clashing_columns(spark, tmp_path, model):
    df = spark.createDataFrame([(1, "u", PAGE, "a", 2)], "page_id long, url string, html string, text string, n_chars long")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = H.op5(spark, str(tmp_path)).collect()[0]
    assert got.text.startswith("Big news") and got.n_chars == len(got.text)
