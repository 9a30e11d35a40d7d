import time

import numpy as np
import pytest

from contrail.llm import html_extraction as H

SF = "/root/testdata/sf0.01"


def texts(page):
    return [b.text for b in H.leaf_blocks(page)]


@pytest.mark.parametrize("page, blocks", [
    ("", []), ("plain &amp; simple", ["plain & simple"]), ("<p>a<b>b</b>\n\t c<p>d", ["ab c", "d"]),
    ("<script>var t='</p>';</script><p>x</p><style>p{}</style>", ["x"]), ("<!-- a <p>b</p> --><p>c</p><!-- open", ["c"]),
    ("<ul><li>1<li>2</ul>tail", ["1", "2", "tail"]), ("a < b<br>c", ["a < b c"]), ("<div a='>' b=\">\">x</div", ["x"]),
    ("<p>&eacute;&#233;&nbsp;&lt;p&gt;</p>", ["éé <p>"]), ("<script>never closed", []), ("<p class=x>y<table><tr><td>1<td>2</table>", ["y", "1", "2"]), ("<p a=\"unclosed>z</p>", ["z"]),
])
def test_leaf_blocks(page, blocks):
    assert texts(page) == blocks


def test_gradient():
    rng = np.random.default_rng(0)
    m = H.BiLstm(width=H.WIDTH, hidden=3)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    x, mask, y = rng.normal(size=(5, 2, H.WIDTH)), np.ones((5, 2)), rng.integers(0, 2, (5, 2)).astype(float)
    mask[3:, 1] = 0

    def loss():
        z, _, _ = m.logits(x, mask)
        return float(((np.log1p(np.exp(z)) - y * z) * mask).sum() / mask.sum())

    g = m.gradient(x, mask, y)
    for name in m.p:
        flat, i = m.p[name].reshape(-1), 1 % m.p[name].size
        old, eps = flat[i], 1e-4
        flat[i] = old + eps
        up = loss()
        flat[i] = old - eps
        down = loss()
        flat[i] = old
        assert abs((up - down) / (2 * eps) - g[name].reshape(-1)[i]) < 1e-3, name


def expected(page):
    """Blocks of the article of a given page."""
    import html
    import re
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"<(?:/?p|/?h1)>", body)]
    return "\n\n".join(p for p in parts if p)


def test_given_pages(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r for r in H.extract_text(pages, layouts=300).collect()}
    rows = pages.collect()
    right = [got[r["page_id"]]["text"] == expected(r["html"]) for r in rows]
    assert np.mean(right) >= 0.98
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_unseen_layouts():
    rng = np.random.default_rng(1)
    stock = [" ".join(f"w{rng.integers(400)}" for _ in range(rng.integers(12, 60))) + "." for _ in range(200)]
    stock_words = [f"w{i}" for i in range(400)]
    model = H.fit_labeller([f"<article><p>{t}</p></article><nav><a>{t[:9]}</a></nav>" for t in stock], layouts=500)
    wrong = total = 0
    for _ in range(150):
        blocks = H.leaf_blocks(H.layout(rng, stock, stock_words))
        y = [b.text.startswith(H.MAIN) for b in blocks]
        for b in blocks:
            b.text = b.text.replace(H.MAIN, "") or "-"
        wrong += int((model.predict([H.vectors(b) for b in [blocks]])[0] != np.array(y)).sum())
        total += len(y)
    assert wrong / total < 0.05


def test_edges(spark):
    long = "<nav>menu</nav><article>" + "<p>some words of a long text, and more.</p>" * 3000 + "</article>"
    rows = [(1, None, "x"), (2, "", "x"), (None, "<p></p>", "x"), (4, long, "x"), (4, long, "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, rest string")
    got = H.extract_text(pages, layouts=50).collect()
    assert [r["text"] for r in got if r["page_id"] != 4] == [""] * 3 and len(got) == 5
    assert len({r["text"] for r in got if r["page_id"] == 4}) == 1 and got[0]["rest"] == "x"
    assert H.extract_text(pages.limit(0), layouts=50).count() == 0


def test_every_word_is_read():
    """Blocks of the same start and end that differ in the middle differ in words, capitals and digits."""
    start, end = "the same words stand at the start of both ", " and the same words stand at the end of both"
    plain, advert = (H.leaf_blocks(f"<div>{start}{x}{end}</div>") for x in ("quiet prose about old rivers", "BUY NOW offer 50 OFF coupon"))
    a, b = H.vectors(plain)[0], H.vectors(advert)[0]
    words = slice(H.PATHS, H.PATHS + H.WORDS)
    assert (a[words] != b[words]).any()
    assert b[H.PATHS + H.WORDS + 5] > a[H.PATHS + H.WORDS + 5] and b[H.PATHS + H.WORDS + 6] > a[H.PATHS + H.WORDS + 6] == 0
    again = H.vectors(H.leaf_blocks(f"<div>{'word ' * 5000}</div>"))[0]
    assert again[words].sum() == pytest.approx(3, rel=1e-4)


@pytest.mark.parametrize("piece", ["<div><b>x y", "<a href='#'><span class='c d'>x ", "<iframe>x ", "</div>x <p>", "<x-a><section>x"])
def test_work_grows_with_the_page(piece):
    """Unclosed and stray tags, however deep, cost the same each."""
    def seconds(n):
        page, best = piece * n, 1e9
        for _ in range(3):
            at = time.process_time()
            blocks = H.leaf_blocks(page)
            best = min(best, time.process_time() - at)
        assert sum(len(b.text.replace(" ", "")) for b in blocks) >= n
        return best
    assert seconds(32_000) < 16 * max(seconds(4_000), 0.005)


def test_unclosed_elements_keep_their_paths():
    deep = H.leaf_blocks("<article><div class='entry'>" + "<b>" * 3_000 + "x<p>y</p></article><nav>z")
    assert [(b.text, b.tags) for b in deep] == [("x", {"article"}), ("y", {"article"}), ("z", {"nav"})]
    assert deep[0].depth == 3_002 and set(deep[0].path) >= {H._bucket(e, H.PATHS) for e in ("<article", "<div", ".entry", "<b", "^b")}
    assert deep[2].path == tuple(sorted({H._bucket("<nav", H.PATHS), H._bucket("^nav", H.PATHS)}))


def test_training_pages(spark):
    rows = [(i % 50, f"<p>{i % 50}</p>") for i in range(500)] + [(None, "<p>none</p>"), (60, None), (61, "x" * 900)]
    pages = spark.createDataFrame(rows, "page_id long, html string").repartition(5)
    all_of_them = H.training_pages(pages, 100, 800)
    assert sorted(all_of_them) == sorted({h for _, h in rows if h and len(h) <= 800})
    assert H.training_pages(pages.repartition(3), 10, 800) == all_of_them[:10]
    assert H.training_pages(pages.limit(0), 10, 800) == []
