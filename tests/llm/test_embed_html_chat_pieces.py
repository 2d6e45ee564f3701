import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import chat as H
from tessera.llm import embed_dedup as E
from tessera.llm import html_extract as X
from tessera.llm import pieces as P
from tests.llm.conftest import SF

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
VECTORS = "vec_id long, embedding array<float>, label int"


def _brute_vectors(rows, t=0.9):
    good = [(i, np.array(v, float)) for i, (_, v, _) in enumerate(rows) if v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i in range(len(rows))}
    for i, a in good:
        for j, b in good:
            if i != j and len(a) == len(b) and a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= t:
                links[i].add(j)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        c = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((rows[i][0], len(links[i]), c, rows[i][0] == c if c is not None and rows[i][0] is not None else False))
    return sorted(out, key=str)


def test_vectors_equal_brute_force(spark):
    r = np.random.default_rng(7)
    centres = r.normal(size=(12, 8))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + r.normal(size=8) * r.choice([0.05, 0.4])], i) for i in range(150)]
    rows += [(200, rows[0][1], 1), (200, rows[0][1], 1), (None, rows[1][1], 1), (201, None, 0), (202, [0.0] * 8, 0), (203, [1.0, None], 0),
             (204, [float("nan")] * 8, 0), (205, [1.0, 2.0], 0), (206, [2.0, 4.0], 0), (207, [], 0), (208, [float("inf")] * 8, 0)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("node", F.lit(1)).withColumn("weight", F.lit("x"))
    for block in (4096, 16):
        assert sorted(map(tuple, E.near_duplicates(df, block=block).collect()), key=str) == _brute_vectors(rows)
    empty = spark.createDataFrame([], VECTORS)
    assert E.near_duplicates(empty).count() == 0
    assert E.near_duplicates(df.where("vec_id = 202")).first()["kept"]


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class="x"><nav><ul><li>Menu</li></ul></nav>
<div class="cookie-notice">We use cookies</div><header><p>Site</p></header><article><h1>Head &amp; tail {i}</h1><p>First <b>bold</b>
 line&nbsp;here {i}<p>Second &lt;para&gt;<br>after break<script>var x = "</p>";</script></p><form><p>Name</p></form>
<div id="comments"><p>Reader says</p></div></article><aside>side</aside><footer>foot</footer></body>"""


def test_main_text(spark):
    rows = [(i, f"http://Host.example/{i}", PAGE.format(i=i)) for i in range(5)]
    rows += [(90, None, None), (91, "http://host.example/x", ""), (92, "bad url", "<p>only < text"), (93, "http://a.b/", "<div>one</div> two <!-- x"),
             (0, "http://Host.example/0", PAGE.format(i=0)), (94, "http://a.b/", "<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("x")).withColumn("slots", F.lit(1))
    out = X.extract_text(df)
    got = [(r["page_id"], r["text"]) for r in out.collect()]
    assert len(got) == len(rows) and set(df.columns) < set(out.columns)
    got = dict(got)
    for i in range(5):
        assert got[i] == f"Head & tail {i}\nFirst bold line here {i}\nSecond <para> after break"
    assert got[90] == got[91] == "" and got[92] == "only < text" and got[93] == "one\ntwo" and got[94] == "a\nb\nc\nd"
    assert X.extract_text(df.where("page_id = -1")).count() == 0


def test_slots_follow_classes(spark):
    rows = [(i, "http://h.x/", f"<body><div class=top>t</div><div class=body><div class=main>{'text ' * 50}{i}</div></div></body>") for i in range(4)]
    slots = X.deduce_templates(spark.createDataFrame(rows, "page_id long, url string, html string")).first()["slots"]
    assert slots[0] == "body/div.body/div.main"


CONV = "conv_id long, turn long, role string, text string"


def test_snapshots_collapse(spark):
    a = [(0, "user", "hi"), (1, "assistant", "yes"), (2, "user", "more"), (3, "assistant", "ok")]
    rows = [(c, *t) for c, n in ((1, 2), (2, 4), (3, 4), (4, 1)) for t in a[:n]]
    rows += [(5, 0, "user", "hi"), (5, 1, "assistant", "no"), (6, 0, None, None), (None, 0, "user", "x"), (7, 0, "user", "a"), (7, 0, "user", "b"),
             (7, 0, "user", "b"), (8, None, "user", "late")]
    df = spark.createDataFrame(rows, CONV).withColumn("pos", F.lit(9)).withColumn("last", F.lit("z"))
    got = {r["conv_id"]: (r["n_turns"], r["text"]) for r in H.format_chats(df).collect()}
    assert set(got) == {2, 5, 6, 7, 8, None}
    assert got[2][0] == 4 and got[2][1].startswith("<|user|>\nhi<|end|>\n<|assistant|>\nyes") and got[7][0] == 2
    assert H.format_chats(df.where("turn > 99")).count() == 0


def test_long_conversation_in_parts(spark):
    df = spark.range(1500).select(F.lit(1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("user").alias("role"), F.col("id").cast("string").alias("text"))
    short = df.where("turn < 700").withColumn("conv_id", F.lit(0).cast("long"))
    got = H.format_chats(df.unionByName(short)).orderBy("part").collect()
    assert [(r["conv_id"], r["part"], r["n_turns"]) for r in got] == [(1, 0, 1500), (1, 1, 1500), (1, 2, 1500)]
    assert "".join(r["text"] for r in got) == "".join(f"<|user|>\n{i}<|end|>\n" for i in range(1500))


TEXTS = ["", "a", " lead and  trail ", "é中\U0001F600\n\t x", "ab" * 60 + "é" * 5 + "q" * 70, "x" + " " * 45 + "z", "The quick brown fox." * 9, "▁odd"]


def test_bpe_ids_equal_the_library():
    sentencepiece = pytest.importorskip("sentencepiece")
    library, table = sentencepiece.SentencePieceProcessor(model_file=MODEL), P.read_pieces(MODEL)
    for text in TEXTS:
        got = P.encode_words(list(dict.fromkeys(P.segments(text, table))), table)
        ids = np.frombuffer(b"".join(got[w] for w in P.segments(text, table)), np.int32).tolist()
        assert ids == library.encode(text)


def test_best_path_equals_brute_force():
    pieces = ["<unk>", "▁", "a", "b", "ab", "ba", "aba", "▁a", "▁ab", "bb"]
    table = P.PieceTable(pieces, np.array([0, -3, -2, -2.5, -3, -3.2, -4.9, -3.3, -4.1, -4.9]), [P.UNKNOWN] + [P.NORMAL] * 9)

    def best(word):
        top = {0: 0.0}
        for end in range(1, len(word) + 1):
            top[end] = max((top[s] + table.scores[pieces.index(word[s:end])] for s in range(end) if word[s:end] in pieces[1:]), default=-np.inf)
            if word[end - 1] not in pieces:
                top[end] = max(top[end], top[end - 1] + table.score[-2])
        return top[len(word)]

    r = np.random.default_rng(2)
    words = {"▁" + "".join(r.choice(list("abc"), r.integers(1, 40))) for _ in range(200)}
    for word, raw in P.encode_words(list(words), table).items():
        ids = np.frombuffer(raw, np.int32)
        want = best(word)
        score = sum(table.scores[i] if i else None or 0 for i in ids if i) + table.score[-2] * sum(c == "c" for c in word)
        assert abs(score - want) < 1e-6


def test_encode_decode_frames(spark, odd, none):
    table = P.read_pieces(MODEL)
    coded = P.encode(odd, table)
    assert set(odd.columns) == set(coded.columns)
    back = P.decode(coded, table).collect()
    assert len(back) == 10 and all(r["decoded"] == r["text"] for r in back)
    assert P.decode(P.encode(none, table), table).count() == 0
    df = spark.createDataFrame([(t,) for t in TEXTS[:-1]], "text string")
    assert all(r["decoded"] == r["text"] for r in P.decode(P.encode(df, table, cache_words=3), table).collect())


def test_registered(spark):
    from tessera.llm.queries import QUERIES
    assert QUERIES["op10_piece_lattice"](spark, SF).where("NOT round_trip").count() == 0
    import re
    from html import unescape
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in QUERIES["op6_template_text"](spark, SF).collect():
        inner = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = [" ".join(unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?p>|</?h1>|<br>", inner)]
        assert r["text"] == "\n".join(x for x in parts if x)


def test_one_long_paragraph_is_not_the_slot(spark):
    rows = [(i, "http://h.x/", f"<article><h1>Head {i}</h1><p>{'text ' * 90}</p></article>") for i in range(3)]
    got = X.extract_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all(r["text"] == f"Head {r['page_id']}\n" + ("text " * 90).strip() for r in got)


def test_chrome_words_in_content_classes():
    def text(page):
        return "\n".join(t for _, t in X.read_page(page)[1])

    for tag in ("<body class='has-sidebar'>", "<body id='no-ads'>", "<body class='menu'>", "<body><div class='sidebar'>"):
        assert text(f"{tag}<main class='content with-sidebar'><article class='post comments-open'><h1>A</h1><p>b c</p></article></main>") == "A\nb c"
    assert text("<article><p class='ad-hoc'>one <span class='menu-item-name'>two</span> <math><mi>x</mi></math> <svg><text>y</text></svg>"
                "<noscript>z</noscript> <object>w</object></p></article>") == "one two x yz w"
    assert text("<body><form role='form'><p>all of the text</p><p class='ad'>buy</p></form>") == "all of the text"
    assert text("<article><p>long enough</p></article><div class='ad-banner'>a</div><div id='left_sidebar'>b</div><p class='x cookie-notice'>c</p>") == "long enough"
    assert text("<main><p>the text of it</p><div class='comments'><article>c</article></div></main>") == "the text of it"
