"""Byte-pair encoding, near-duplicates, components, chat and pages against brute force."""

import random
import re

import pytest
from pyspark.sql import functions as F

from sievemark.llm import bpe, chat, components, html_text, near_dedup
from sievemark.llm.grouping import per_group

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")
ALPHABETS = [
    "abcdefghijklmnopqrstuvwxyz", "aaab", "théçéñüß", "漢字仮名交じり文", "!?.,;-", "abc'sd", "0123ab",
    " \n\tab", "İıΣσς", "éä", "한국어", "😀🎉x", "ªº²½µ", "\x1c\x85\xa0 ab", "가각가",
]
PIECES = ["<|endoftext|>", " ", "'s", "'re", "<|startoftext|>", "<|", "</w>"]


def odd_text(n):
    return "".join(
        random.choice(random.choice(ALPHABETS)) if random.random() < 0.9 else random.choice(PIECES)
        for _ in range(random.randint(0, n))
    )


def test_encoding_equals_the_library_whole_and_as_a_tree():
    random.seed(10)
    encoder = bpe.Encoder(PATH)
    library = tokenizers.Tokenizer.from_file(PATH)
    for n in range(600):
        letters = random.choice(ALPHABETS)
        text = odd_text(120) if n % 2 else "".join(random.choice(letters) for _ in range(150))
        want = library.encode(text, add_special_tokens=False).ids
        assert encoder.encode(text).tolist() == want
        cuts = list(encoder.cuts(text, random.choice([4, 8, 16, 40])))
        assert "".join(text[a:b] for a, b, _ in cuts) == text
        joins = [j for *_, j in cuts]
        parts = [
            encoder.encode_piece(text[a:b], on)
            for (a, b, _), on in zip(cuts, [*joins[1:], False])
        ]
        assert encoder.concatenate(parts, joins).ids.tolist() == want
        assert encoder.decode(encoder.encode(text)) == library.decode(want, skip_special_tokens=False)


def test_long_texts_in_spark_pieces(spark):
    random.seed(11)
    library = tokenizers.Tokenizer.from_file(PATH)
    texts = ["".join(random.choice("abcdethr") for _ in range(3000)), None, "", "x " * 2000, "漢字" * 800]
    texts += ["漢字" * 800, "!?" * 900, odd_text(3000)]
    rows = [(i % 6, t, "clash", i) for i, t in enumerate(texts)] + [(None, "a b", "c", 9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, kept string, number int")
    found = bpe.encode(table, PATH, piece=128).collect()
    assert len(found) == len(rows)
    by = {r.number: r for r in found}
    for doc_id, text, kept, number in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert (by[number].doc_id, by[number].kept, by[number].ids) == (doc_id, kept, ids)
        assert by[number].decoded == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(table.where("false"), PATH).collect() == []


def near_by_hand(docs, k, percent):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        sets.append({tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set())
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (doc_id, _), x in zip(docs, label):
        least.setdefault(x, []).append(doc_id)
    return [
        (d, len(s), min((i for i in least[x] if i is not None), default=None))
        for (d, _), s, x in zip(docs, sets, label)
    ]


def near_documents():
    random.seed(12)
    vocabulary = [f"w{i}" for i in range(2000)]
    docs, n = [], 0
    for group in range(12):
        base = [random.choice(vocabulary) for _ in range(random.randint(3, 150))]
        for _ in range(random.choice([1, 2, 6, 40])):
            own = list(base)
            for _ in range(random.choice([0, 0, 1, 2, 4, 7])):
                own[random.randrange(len(own))] = random.choice(vocabulary)
            docs.append((n, " ".join(own).upper() if n % 5 == 0 else "\n".join(own)))
            n += 1
    docs += [(900, None), (901, ""), (902, " \t"), (903, "w1"), (904, "W1"), (905, "w1 w2"), (906, "É"), (907, "é")]
    docs += [(docs[0][0], docs[0][1]), (None, docs[3][1]), (None, "alone again and again"), (5, "another text altogether")]
    return docs


@pytest.mark.parametrize("k,percent,small,block", [(3, 85, 1024, 256), (5, 80, 1024, 256), (3, 85, 8, 4)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, k, percent, small, block):
    monkeypatch.setattr(near_dedup, "SMALL", small)
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    docs = near_documents()
    table = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, row int, label string")
    rows = near_dedup.near_duplicates(table, k, percent).collect()
    expected = near_by_hand(docs, k, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr) == sorted(expected, key=repr)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_one_document_of_each_group_stays(spark):
    docs = near_documents()
    table = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, label string")
    kept = near_dedup.keep_one(table, 3, 85)
    assert kept.columns == ["doc_id", "text", "label"]
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    grouped = near_dedup.grouped(table, 3, 85).where("label is not null")
    lone = grouped.groupBy("label").count().count()
    alone = len(docs) - grouped.count()
    assert len(rows) == lone + alone and set(rows) <= set(docs)
    assert near_dedup.keep_one(table.where("false"), 3, 85).collect() == []
    assert near_dedup.near_duplicates(table.where("false")).collect() == []


def test_texts_that_share_an_id_are_read_once(spark, monkeypatch):
    rows = [(None if i % 3 else 7, f"w{i // 2} " + " ".join(f"x{i // 2}y{j}" for j in range(30))) for i in range(400)]
    rows += rows[:10]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    read = []
    whole = near_dedup._full_sets

    def counted(docs, wanted, *given):
        read.append((docs, wanted))
        return whole(docs, wanted, *given)

    monkeypatch.setattr(near_dedup, "_full_sets", counted)
    # Variants of one text, all of which are linked.
    long = " ".join(f"z{j}" for j in range(200))
    table = table.unionByName(
        spark.createDataFrame([(None, f"{long} end{i}") for i in range(50)], "doc_id long, text string")
    )
    found = near_dedup.near_duplicates(table, 3, 85).collect()
    assert len(found) == 460
    kept = near_dedup.keep_one(table, 3, 85)
    assert kept.count() == 201
    docs, wanted = read[0]
    assert wanted.select("id", "version").distinct().count() == wanted.count() == 50


def test_components_of_paths_stars_and_cycles(spark):
    random.seed(13)
    edges = [(i, i + 1) for i in range(100, 160)] + [(0, i) for i in range(1, 50)] + [(7, 7)]
    edges += [(i, (i - 200 + 1) % 30 + 200) for i in range(200, 230)]
    edges += [(random.randrange(300, 400), random.randrange(300, 400)) for _ in range(60)]
    random.shuffle(edges)
    label = {n: n for e in edges for n in e}
    for _ in edges:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    found = components.components(spark.createDataFrame(edges, "a long, b long"))
    lonely = {n for n in label if all(n not in e or e[0] == e[1] for e in edges)}
    assert {r.node: r.label for r in found.collect()} == {n: x for n, x in label.items() if n not in lonely}
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_groups_are_whole_across_batches(spark):
    import pyarrow as pa

    table = spark.range(5000).select((F.col("id") % 7).alias("g"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "100")
    try:
        found = per_group(
            table, ["g"], lambda t: pa.table({"g": t["g"][:1], "n": [t.num_rows]}), "g long, n long"
        ).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert sorted(map(tuple, found)) == [(g, len(range(g, 5000, 7))) for g in range(7)]


def test_chat_round_trip_with_parts(spark):
    def part(kind, text=None, **more):
        empty = {"reference": None, "width": None, "height": None, "seconds": None, "pages": None}
        return {"kind": kind, "text": text, **empty, **more}

    hard = "\\### A: </turn> <image 0> \\\\ #\n</turn>\n<turn user>\nx"
    messages = [
        (1, 0, "user", [part("text", hard), part("image", reference="a.png", width=57, height=28), part("text", "b")]),
        (1, 1, "assistant", [part("audio", reference="s.wav", seconds=2.01), part("text", hard), None,
                             part("document", reference="d.pdf", pages=3), part("other", "c")]),
        (1, 2, "ro>le\n<x\\n", []),
        (2, None, None, None),
        (None, 0, "assistant", [part("text", None)]),
    ]
    table = spark.createDataFrame(messages, f"conv_id long, turn long, role string, parts array<{chat.PART}>")
    rows = {(r.conv_id, r.turn): r for r in chat.format_turns(table).collect()}
    attached = rows[(1, 1)].attachments
    assert [(a.number, a.kind, a.reference, a.tokens) for a in attached] == [
        (0, "audio", "s.wav", 51), (1, "document", "d.pdf", 3 * 1024)]
    text = rows[(1, 1)].formatted
    assert [text[a.place :].startswith(f"<{a.kind} {a.number}>") for a in attached] == [True, True]
    assert rows[(1, 1)].attachment_tokens == 51 + 3072 and rows[(1, 0)].attachment_tokens == 3
    masked = [chat.unescape(text[s.start : s.stop]) for s in rows[(1, 1)].loss]
    assert masked == [hard, "c"] and rows[(1, 0)].loss == []
    whole = "".join(rows[(1, turn)].formatted for turn in (0, 1, 2))
    assert list(chat.read_turn(whole)) == [
        ("user", f"{hard}<image 0>b"), ("assistant", f"<audio 0>{hard}<document 1>c"), ("ro>le\n<x\\n", "")]
    back = {r.conv_id: r for r in chat.read_back(chat.format_turns(table)).collect()}
    assert back[1].n_turns == 3 and back[1].loss_chars == len(hard) + 1
    assert back[2].n_turns == 1 and back[None].loss_chars == 0
    assert chat.read_back(chat.format_turns(table.where("false"))).collect() == []


PAGES = [
    ("<p>a<p>b<div>c</div>d", "a\n\nb\n\nc\nd"),
    ("<ul><li>x<li>y<ol><li>1<li>2</ol></ul>z", "- x\n- y\n  1. 1\n  2. 2\n\nz"),
    ("<table><tr><th>Name<th>N<tr><td>ab<td>1<br>2</table>", "Name  N\nab    1\n      2"),
    ("<table><caption>C</caption><tbody><tr><td>1</td></tr></table>after", "C\n1\n\nafter"),
    ("<head><title>t</title></head><body>x<script>if(a<b)'</p>'</script><style>p{}</style>y", "xy"),
    ("<div hidden>n</div><p style='color:red; DISPLAY : none'>n</p><i style=visibility:hidden>n</i>y", "y"),
    ("<pre>\n a\n  b &lt;</pre>", " a\n  b <"),
    ("a &amp; b&nbsp;&copy; <!-- no --> c<br>d", "a & b\xa0\xa9 c\nd"),
    ("<details><summary>S</summary>no</details><details open><summary>T</summary>yes</details>", "S\nT\nyes"),
    ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n    d1\n    d2"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("1 < 2 <b>x</i></b> </unknown> y", "1 < 2 x y"),
    ("<h1>H</h1>t<hr>u", "H\n\nt\n\nu"),
    ("<select><option>a<option>b</select>", "ab"),
    ("<input type=hidden value=n><input value=v>", "v"),
    ("<textarea><b>raw</b></textarea>", "<b>raw</b>"),
    ("<table>before<tr><td>1<td>2<tr>loose<td>3</table>", "beforeloose\n\n1  2\n3"),
    ("", ""),
    ("   \n ", ""),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_visible_text(page, text):
    assert html_text.visible_text(page) == text


def test_deep_and_long_pages():
    assert html_text.visible_text("<div>" * 5000 + "x" + "</div>" * 5000 + "y") == "x\ny"
    assert html_text.visible_text("<table><tr><td>" * 300 + "x").strip() == "x"
    assert len(html_text.visible_text("<p>word " * 20_000).split()) == 20_000


@pytest.mark.parametrize("depth", [130, 3000])
def test_rules_hold_at_any_depth(depth):
    inner = (
        "<p>a<script>s</script><style>s</style><i hidden>h</i><b style='display:none'>h</b></p>"
        "<ul><li>x<li>y</ul><table><tr><td>1<td>2</table><pre>p<b>q</b></pre>"
    )
    shallow = html_text.visible_text(f"<div>{inner}</div>z")
    assert html_text.visible_text("<div>" * depth + inner + "</div>" * depth + "z") == shallow
    nested = html_text.visible_text("<ul><li>" * depth + "x" + "</li></ul>" * depth + "y").split("\n")
    assert nested[0].endswith("- x") and nested[-1] == "y"
    quoted = html_text.visible_text("<pre>" + "<b>" * depth + "t" + "</b>" * depth + "</pre>u")
    assert quoted == "t\n\nu"


def test_text_of_pictures_and_formulas():
    picture = (
        "a<svg width='9'><title>t</title><desc>d</desc><path d='M0'/><g>x<text>one</text>"
        "<text>t<tspan>wo</tspan></text></g><style/><defs><text>n</text></defs></svg>b"
    )
    assert html_text.visible_text(picture) == "a one two b"
    formula = (
        "<math><semantics><mrow><mi>x</mi><mo>=</mo><mn>1</mn></mrow>"
        "<annotation>x=1</annotation></semantics></math>."
    )
    assert html_text.visible_text(formula) == "x=1."


def test_pages_in_spark(spark):
    rows = [(i, p, "u", "clash") for i, (p, _) in enumerate(PAGES)] + [(None, None, None, None)]
    table = spark.createDataFrame(rows, "page_id long, html string, kept string, text string")
    found = {r.page_id: r for r in html_text.extract(table).collect()}
    assert found[None].text is None
    assert all(found[i].text == text and found[i].kept == "u" for i, (_, text) in enumerate(PAGES))
    assert html_text.extract(table.where("false")).collect() == []
