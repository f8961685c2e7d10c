"""Wrapper induction: simple tree matching against plain recursion, extraction against a plain version on made sites."""

import json
import random
from collections import Counter, defaultdict

import pytest

from terrafold.llm import html_extract as he

SCHEMA = "page_id long, url string, html string, host string, text string, shape string, nodes int, part int"


def plain_matching(a, b):
    """Yang's recursion over (label, children)."""
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + plain_matching(x, y))
    return m[-1][-1] + 1


def made_tree(rng, depth):
    return (rng.choice("abc"), [made_tree(rng, depth - 1) for _ in range(rng.randrange(0, 4))] if depth else [])


def flat(tree):
    parent, label = [], []

    def walk(t, up):
        parent.append(up)
        label.append(t[0])
        at = len(parent) - 1
        for c in t[1]:
            walk(c, at)

    walk(tree, -1)
    return parent, label


def test_matching_equals_plain_recursion_and_the_alignment_has_its_size():
    rng = random.Random(4)
    for _ in range(150):
        a, b = ("#", [made_tree(rng, 3) for _ in range(3)]), ("#", [made_tree(rng, 3) for _ in range(3)])
        fa, fb = flat(a), flat(b)
        to = he.align(json.dumps(fa), json.dumps(fb))
        assert sum(x >= 0 for x in to) == plain_matching(a, b)
        used = [x for x in to if x >= 0]
        assert len(set(used)) == len(used)
        for i, x in enumerate(to):
            if x >= 0:
                assert fa[1][i] == fb[1][x] and (i == 0 or to[fa[0][i]] == fb[0][x])


def test_page_rules():
    page = he.Page("""<!doctype html><html><head><title>T</title><style>p{}</style><meta x></head><body class="has-sidebar header-fixed">
      <header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li>B</ul></nav><div id="cookie-notice">We use cookies</div>
      <article class="post with-sidebar"><header><h1>Big &amp; <i>new</i>&#33;</h1></header><p>one<br>two\n\n three &lt;b&gt;&nbsp;x<p>un<b>closed
      <script>var t="</article><p>no</p>";</script><ul><li>a<li>b <span class=share>tweet</span> c</ul><!-- <p>hidden</p> --><table><tr><td>c1<td>c2</table>
      <a title="a>b" href=x>link text</a><form><p>mail?</p><input></form><section class="comments"><article><p>me too</p></article></section></article>
      <aside>side</aside><div class="ad">buy</div><footer>&copy;</footer></body></html><p>&amp""")
    assert page.texts == ["Big & new!", "one two three <b> x", "unclosed", "a", "b c", "c1", "c2", "link text"]
    free = he.Page("<div>Some text <a>here</a> that is long</div><ul><li><a>Menu</a></li></ul><p>tail &lt 3 < 4 <5")
    assert free.texts == ["Some text here that is long", "tail < 3 < 4 <5"]
    assert he.Page("<nav><p>x<div></nav></div><p>kept").texts == ["kept"]
    assert he.Page("<div><nav>never closed</div><p>kept</p>").texts == ["kept"]
    kept = he.Page('<div class="page share-enabled search-results menu-open ad-free"><p>kept</p><div class="ad-1">x</div><div class="promo_box">x</div><div id="user-comments">x</div></div>')
    assert kept.texts == ["kept"]
    assert he.Page("").texts == [] == he.Page("<p").texts == he.Page("<!-- <p>x").texts


def test_deep_and_wide_pages():
    deep = he.Page("<div>" * 20000 + "x" + "</div>" * 20000)
    assert deep.texts == ["x"] and he.align(deep.shape(), deep.shape())[-1] == 20000
    wide = he.Page("".join(f"<h2>t{i}</h2><p>x{i}</p>" for i in range(1500)))
    assert len(wide.texts) == 3000 and min(he.align(wide.shape(), wide.shape())) == 0
    he.Page("<b>" * 50000 + "<a href='" * 3000 + "<x " * 3000)


def plain(rows, min_pages, share):
    """Wrappers and texts with dictionaries only, over the same trees."""
    host = lambda u: u.split("://", 1)[1].split("/")[0].split("?")[0].split("#")[0].lower() if u and "://" in u else ""
    pages = [(i, u, host(u), he.Page(h or "")) for i, u, h in rows]
    seen = defaultdict(dict)
    for _, _, h, p in pages:
        if p.texts:
            key = tuple(p.texts)
            new = (p.shape(), p.nodes, [he.text_hash(t) for t in p.texts])
            seen[h][key] = min(seen[h].get(key, new), new)
    drop = {}
    for h, group in seen.items():
        if len(group) < min_pages:
            continue
        wrapper = max((c, s) for s, c in Counter(x[0] for x in group.values()).items())[1]
        texts, any_ = Counter(), Counter()
        for shape, nodes, hashes in group.values():
            to = he.align(shape, wrapper)
            at = {(to[n], t) for n, t in zip(nodes, hashes) if to[n] >= 0}
            texts.update(at)
            any_.update({n for n, _ in at})
        drop[h] = wrapper, {k for k, c in texts.items() if c >= min_pages and c >= share * any_[k[0]]}
    out = []
    for i, u, h, p in pages:
        kept = p.texts
        if h in drop:
            to = he.align(p.shape(), drop[h][0])
            kept = [t for n, t in zip(p.nodes, p.texts) if (to[n], he.text_hash(t)) not in drop[h][1]]
        out.append((i, u, "\n".join(kept), len("\n".join(kept))))
    return out


def site(rng):
    """Pages of hosts with their own frames: constant notes in the article, optional parts, copies under other frames."""
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(4))
    rows, at = [], 0
    for h, n in (("Big.example", 80), ("small.example", 9), ("two.example", 2), ("flat.example", 12)):
        for k in range(n):
            body = "".join(f"<p>{' '.join(word() for _ in range(6))}</p>" for _ in range(rng.randrange(1, 5)))
            if k % 7 == 3:
                body = "<p>copied over and over</p><p>second</p>"
            note = "<div><p>All texts are ours.</p></div>" if h != "two.example" else ""
            extra = f"<div><p>{word()}</p><p>Read it on paper</p></div>" if k % 3 == 0 else ""
            inner = f"<h1>{word()}</h1>{extra}{body}{note}"
            page = f"<article>{inner}</article>" if h != "flat.example" else f"<div>{inner}</div><ul><li><a>{word()}</a></li></ul>"
            rows.append((at, f"http://{h}/{k}?x", f"<body><nav><a>{word()}</a></nav>{page}<footer>{word()}</footer></body>"))
            at += 1
    return rows


@pytest.mark.parametrize("broadcast", [he.BROADCAST_BYTES, -1])
def test_extraction_matches_plain_version(spark, monkeypatch, broadcast):
    monkeypatch.setattr(he, "BROADCAST_BYTES", broadcast)
    rows = site(random.Random(11))
    rows += [(900, None, "<p>a</p>"), (901, "no host", "<p>a</p><p>b</p>"), (902, "x://e.example/", None), (903, "x://e.example", ""), (None, "x://e.example", "<p>z"),
             rows[0], rows[0], (904, "http://Big.example/long", "<article>" + "<p>w w w</p>" * 30000 + "</article>")]
    df = spark.createDataFrame([(*r, "h", "t", "s", 1, 2) for r in rows], SCHEMA)
    key = lambda r: (str(r[0]), str(r[1]), r[2])
    got = sorted((tuple(r) for r in he.extract(df).collect()), key=key)
    assert got == sorted(plain(rows, he.MIN_PAGES, he.SHARE), key=key)
    texts = {r[0]: r[2] for r in got}
    assert not any("All texts are ours." in t for t in texts.values())
    assert texts[3].endswith("copied over and over\nsecond") and he.extract(df.limit(0)).count() == 0
