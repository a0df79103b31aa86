"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fleetlake.llm import ann, chat, decontam, licenses, lines, minhash, packing, template, toxicity, urls
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 997}x{i % 89}" for i in range(30_000))
PROSE = "one two three four five six seven eight nine ten eleven twelve"
ROWS = [
    (1, PROSE), (2, PROSE), (2, PROSE), (3, PROSE + " thirteen"), (4, ""), (5, None), (6, " \n\t"), (7, "alpha beta"), (8, "alpha  BETA"),
    (9, LONG), (10, LONG + " end"), (None, PROSE), (11, "\x01\x01\n\x01\x02 é中\n"), (12, "a\n\nb"),
]


@pytest.fixture
def docs(spark):
    frame = spark.createDataFrame([(i, t, None, "s", None) for i, t in ROWS], DOCS)
    clashing = ["kept", "component_id", "bands", "key", "place", "chunk", "_drop", "score", "segment", "length", "id", "n"]
    return frame.select("*", *[F.lit("x").alias(name) for name in clashing])


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def test_minhash(docs, nothing):
    rows = minhash.classes(docs).collect()
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows}
    assert len(rows) == len(ROWS) and found[None][1:] == (None, True)
    classes = brute.near_classes([(i, t) for i, t in ROWS if i is not None], 85)
    for i, t in ROWS:
        if i is not None:
            assert found[i] == (len(brute.shingles(t)), classes[i], classes[i] == i)
    assert minhash.classes(nothing).collect() == []


def test_minhash_chain_of_links(spark):
    """A class that no single member is linked to as a whole: each text differs from the next by a little."""
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(40):
        words = words.copy()
        words[i * 10] = f"changed{i}"
        rows.append((i, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in minhash.classes(frame).collect()} == brute.near_classes(rows, 85)


def test_minhash_estimate():
    draw = np.random.default_rng(1)
    both, a, b = (draw.integers(0, 2**63, n, dtype=np.uint64) for n in (1700, 150, 150))
    x, y = (minhash.packed(minhash.minima(np.concatenate([both, own]))) for own in (a, b))
    agreeing = minhash.PERMUTATIONS - sum(int(((p ^ q) | ((p ^ q) >> np.uint64(1))) & np.uint64(minhash._LOWEST)).bit_count() for p, q in zip(x, y))
    assert minhash.similarity(agreeing) == pytest.approx(0.85, abs=0.15)
    assert agreeing >= minhash.least_agreement(0.85)


def test_lines(spark, docs, nothing):
    passage = "\n".join(["first line of it", "second line", " ".join(["many"] * 60), "third"])
    more = spark.createDataFrame([(50 + k, f"own {k}\n{passage}\nend {k}") for k in range(3)], "doc_id long, text string")
    cut = lines.without_repeats(docs)
    assert cut.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text or "") for r in cut.collect()) == sorted((i or 0, (brute.without_repeats([(j, t) for j, t in ROWS if j is not None])[i] if i is not None else t) or "") for i, t in ROWS)
    found = {r.doc_id: r.text for r in lines.without_repeats(more).collect()}
    assert found == brute.without_repeats([(r.doc_id, r.text) for r in more.collect()])
    assert sum(t.count("many") for t in found.values()) == 60
    assert lines.without_repeats(nothing).collect() == []


def test_lines_of_a_passage_in_short_lines_all_go(spark):
    draw = random.Random(4)
    line = lambda n=10: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    rows = []
    for k, size in enumerate([6, 7, 10, 20] * 8):
        passage = [line() for _ in range(size)]
        rows += [(i, "\n".join([*(line() for _ in range(3)), *passage, *(line() for _ in range(2))])) for i in (2 * k, 2 * k + 1)]
        rows[-1] = (rows[-1][0], rows[-1][1].replace("\n", "\n\n"))
    found = {r.doc_id: r.text for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [len(found[i].split()) for i, _ in rows if i % 2] == [50] * 32
    assert all(found[i] == text for i, text in rows if i % 2 == 0)
    # A run of 50 words stays, one more word and it goes; single lines and the order of other lines do not matter.
    first, second = line(25), line(25)
    rows = [(1, f"{first}\n{second}"), (2, f"x\n{first}\ny\n{second}"), (3, f"{second} z"), (4, f"{line(51)}\nown"), (5, "\n  \nown\n\n")]
    rows += [(6, rows[3][1].split("\n")[0] + "\n\n\nmine")]
    found = {r.doc_id: r.text for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == dict(rows) | {6: "mine"}


def test_lines_of_few_kinds_equal_the_comparison_of_all_places(spark):
    draw = random.Random(9)
    kinds = ["", " ", "a", "b c", "d " * 20, "e " * 30, "f " * 49 + "f", "g " * 51, "\x0c", "\u00a0 h"]
    rows = [(i, "\n".join(draw.choices(kinds, k=draw.randrange(1, 14)))) for i in range(60)] + [(90, "a\n" * 300), (91, "a\nb c\n" * 90)]
    found = {r.doc_id: r.text for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert found == brute.without_repeats(rows)


def test_lines_that_share_a_hash_alone_stay(spark, monkeypatch):
    monkeypatch.setattr(lines, "passage_key", lambda chunk: F.length(chunk))
    rows = [(k, f"{'a' if k == 2 else 'b'} " * 60 + "\nx") for k in range(4)]
    found = {r.doc_id: r.text for r in lines.without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [found[k].startswith(text[:9]) for k, text in rows] == [True, False, True, False] and found[2].startswith("a " * 60)


def test_decontamination(spark, docs, nothing):
    items = [(1, PROSE), (2, "alpha beta"), (2, "alpha beta"), (3, ""), (4, None), (None, "seven eight nine"), (10, "word1x1 word2x2 word3x3")]
    frame = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    named = [(i, t) for i, t in items if i is not None]
    for block_words in (decontam.BLOCK_WORDS, 3):
        rows = decontam.hits(docs, frame, block_words=block_words).collect()
        found = sorted((r.doc_id or 0, r.n_words, sum(b - a + 1 for a, b in zip(r.spans[::2], r.spans[1::2])), tuple(r["items"])) for r in rows)
        assert found == sorted((i or 0, *brute.contamination(t, named)[:2], tuple(brute.contamination(t, named)[2])) for i, t in ROWS)
    assert decontam.contaminated(nothing, frame).collect() == []
    assert not any(r.contaminated for r in decontam.contaminated(docs, frame.limit(0)).collect())
    near = decontam.proximity(docs, spark.createDataFrame([(1, "twelve one"), (2, "one word1x1")], "item_id long, text string"), within=12).collect()
    assert {(r.doc_id, r.item_id) for r in near} == {(1, "1"), (2, "1"), (3, "1"), (None, "1")}


def test_postings_are_read_back():
    draw = np.random.default_rng(3)
    values = np.concatenate([draw.integers(0, 2**k, 50) for k in (1, 7, 8, 14, 21, 28, 40)]).astype(np.int64)
    data, _ = decontam.varints(values)
    assert (decontam.numbers(data.tobytes()) == values).all()


def test_toxicity(spark, docs, nothing):
    draw = np.random.default_rng(5)
    plain = [f"calm{i}" for i in range(60)]
    rows, labels = [], []
    for i in range(400):
        sentences = [" ".join(draw.choice(plain, 8)) for _ in range(4)]
        if i % 5 == 0:
            sentences[int(draw.integers(4))] += draw.choice([" vileness", " vilely", " horrid"])
        rows.append((i, ". ".join(sentences)))
        labels.append((i, int(i % 5 == 0) if i % 7 else None, "clash"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(frame, spark.createDataFrame(labels, "doc_id long, toxic int, text string"))
    judged = {r.doc_id: r for r in toxicity.judged(frame, model).collect()}
    assert all(judged[i].predicted == int(i % 5 == 0) for i in judged)
    spots = toxicity.offending(frame, model, 0.5).collect()
    assert {r.doc_id for r in spots} == {i for i in judged if i % 5 == 0} and all("vile" in r.sentence or "horrid" in r.sentence for r in spots)
    assert toxicity.without_toxic(frame, model).count() == 320
    edge = toxicity.judged(docs, model).collect()
    assert len(edge) == len(ROWS) and {r.score for r in edge if r.doc_id in (4, 5, 6)} == {0.0}
    assert toxicity.judged(nothing, model).collect() == []
    none = toxicity.train(frame, spark.createDataFrame([], "doc_id long, toxic int"))
    assert all(r.score < 1e-9 for r in toxicity.judged(frame, none).collect())


def test_packing(docs, nothing):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = packing.packed(docs.where("doc_id <> 2 or doc_id is null"), path).collect()
    texts = {i: t for i, t in ROWS if i != 2}
    brute.check_packing(rows, texts, Tokenizer.from_file(path))
    assert packing.packed(docs, path).where("doc_id = 2").count() == 2
    assert packing.packed(nothing, path).collect() == []


def test_encoder_equals_the_tokenizer():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole, parts, pick = Tokenizer.from_file(path), packing.Encoder(path), random.Random(1)
    pieces = [*"aZéñ\t\ń  \x1c\x85'<|>0９ß中😀.,!?​İﬁΣς", "<|endoftext|>", "'s", "'LL", " ", "\r\n", "word", "WORD."]
    for _ in range(3000):
        text = "".join(pick.choice(pieces) for _ in range(pick.randint(0, 30)))
        assert list(np.frombuffer(parts([text.encode()])[0], "<u4")) == [*whole.encode(text, add_special_tokens=False).ids, 1], repr(text)


def test_plan_uses_each_length_as_often_as_it_comes():
    draw = np.random.default_rng(2)
    for capacity, n in ((100, 2000), (4096, 500), (10, 30)):
        lengths, counts = np.unique(draw.integers(1, capacity + 1, n), return_counts=True)
        made = packing.plan(dict(zip(lengths.tolist(), counts.tolist())), capacity)
        fill = {}
        for length, _, count, first, offset in made.runs:
            for k in range(count):
                assert fill.get(first + k, 0) == offset
                fill[first + k] = offset + length
        assert max(fill.values()) <= capacity
        assert made.taken[lengths].tolist() == counts.tolist()
        assert len(fill) == made.sequences <= 1.1 * int((lengths * counts).sum()) / capacity + 20


def test_neighbours(spark):
    rows = [(i, [float(i % 7), 1.0, -float(i % 3)]) for i in range(60)]
    rows += [(100, None), (101, [0.0, 0.0, 0.0]), (102, [1.0, None, 1.0]), (103, [float("nan"), 1.0, 1.0]), (104, [float("inf"), 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (105, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cell", F.lit(1)).withColumn("score", F.lit("x"))
    found = {}
    for r in ann.nearest(frame.union(frame.where("vec_id = 3")), F.col("vec_id") % 20 == 0, 5).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    good = {i: np.array(v) for i, v in rows if i is not None and i < 60}
    assert set(found) == {0, 20, 40}
    for query, got in found.items():
        best = sorted((-float(good[query] @ v), i) for i, v in good.items() if i != query)[:5]
        assert [(r, i, -s) for r, i, s in sorted(got)] == [(k + 1, i, s) for k, (s, i) in enumerate(best)]
    assert ann.nearest(frame.limit(0), F.col("vec_id") % 20 == 0).collect() == []
    assert len(ann.nearest(frame.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).collect()) == 2
    short = spark.createDataFrame([(-5, [1.0]), (3, [9.0, 9.0, 9.0])], "vec_id long, embedding array<float>")  # before all others; a second vector of an id
    again = ann.nearest(frame.select("vec_id", "embedding").union(short), F.col("vec_id") % 20 == 0, 5).collect()
    assert {r.query_id for r in again} == {0, 20, 40} and -5 not in {r.vec_id for r in again}


def test_neighbours_recall(spark):
    """At the largest test size, against all inner products."""
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = frame.collect()
    ids, matrix = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = {}
    for r in ann.nearest(frame, F.col("vec_id") % 20 == 0).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    right = 0
    for query in ids[ids % 20 == 0]:
        scores = (matrix * matrix[ids == query]).sum(axis=1)
        order = [int(ids[k]) for k in np.lexsort((ids, -scores)) if ids[k] != query][:20]
        right += len(found[int(query)].intersection(order))
    assert right >= 0.95 * 20 * len(found)


def test_licenses(docs, nothing, spark):
    assert len(licenses.labelled(docs).collect()) == len(ROWS) and licenses.labelled(nothing).collect() == []
    texts = [
        (1, "Text. This work is licensed under the GNU General Public License, version 3. More."),
        (2, "under the MIT license under the mit license CC BY-NC 4.0"), (3, "the license under version"),
        (4, "Licensed under Apache License, Version 2.0"), (5, "cc by sa cc by cc by nc nc"),
    ]
    found = {r.doc_id: r for r in licenses.labelled(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    assert found[1].labels == "gpl-3" and found[1].n_base == 0 and found[1].score == 1.0
    assert (found[2].n_base, found[2].first_word, found[2].last_word, found[2].base_labels) == (3, 0, 8, "cc-by-nc,mit")
    assert found[3].labels == "" and found[3].score < 0.75
    assert found[4].labels == "apache-2"
    assert (found[5].n_base, found[5].first_word) == (1, 5)


@pytest.mark.parametrize("text, labels", [
    ("This work is licensed under the GNU General Public License, version 2.", "gpl-2"),
    ("GNU General Public License version 2", "gpl-2"), ("the gnu general public license, version 3 or later", "gpl-3"),
    ("Licensed under the Apache License, Version 1.1", ""), ("Licensed under the Apache License, Version 2.0", "apache-2"),
    ("Creative Commons Attribution 4.0 International License", "cc-by"),
    ("Creative Commons Attribution-NonCommercial 4.0 International License", "cc-by-nc"),
    ("Creative Commons Attribution-ShareAlike 4.0 International License", "cc-by-sa"),
    ("Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License", "cc-by-nc-sa"),
    ("Licensed under CC BY 4.0.", "cc-by"), ("Licensed under CC BY-SA 4.0.", "cc-by-sa"), ("Licensed under CC BY-ND 4.0.", "cc-by-nd"),
    ("GNU General Public License version 2. x y z GNU General Public License version 3", "gpl-2,gpl-3"),
])
def test_sibling_licences(text, labels):
    found = licenses.automaton()
    _, places, spans = found.scan(text.encode())
    named = {found.templates[s[0]][0] for s in found.named(spans, licenses.COVER)} | {found.base[k][0] for _, k in places}
    assert ",".join(sorted(named)) == labels


def test_inner_parts_of_a_run_count_for_other_templates():
    found = licenses.automaton([("long", "a b c d e f g h"), ("inner", "d e f g")], {})
    _, _, spans = found.scan(b"x a b c d e f g h y")
    assert {(found.templates[s[0]][0], s[1], s[2], s[3]) for s in spans} == {("long", 1, 8, 1.0), ("inner", 4, 4, 1.0)}


def test_urls(spark):
    texts = ["http://A.Example.com/en/1?x#y", "no scheme", None, "://", "http://x.com", "http://notcom/", "ftp://net/es/", "http://b.net?/es/", "http://a.org/" + "long/" * 3000]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, texts[0]])], "page_id long, url string").withColumn("verdict", F.lit("x")).withColumn("id", F.lit(1))
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("net", "/es/", "block")]
    found = {r.page_id: r for r in urls.verdicts(frame, rules).collect()}
    assert len(found) == 10
    assert (found[0].host, found[0].path, found[0].rule, found[0].verdict) == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert all((found[i].host, found[i].path, found[i].rule, found[i].score) == ("", "", None, 0.0) for i in (1, 2, 3))
    assert (found[4].host, found[4].path, found[4].rule) == ("x.com", "", None)
    assert found[5].rule is None and found[6].rule == "net/es/" and (found[7].host, found[7].path) == ("b.net", "")
    assert {r.verdict for r in found.values()} <= {"allow", "block"}
    assert urls.verdicts(frame.limit(0), rules).collect() == []


def test_chat(spark):
    rows = [
        (1, 1, "user", "a\\<|im_end|>b"), (1, 0, "system", None), (1, 2, "user", "<\\|x"), (1, 3, "assistant", "é<|turn|>😀"), (1, 4, "assistant", "\n"),
        (2, None, None, "x"), (2, 0, "assistant\n<|im_start|>", "y"), (2, 0, "assistant", "y"), (2, 0, "assistant", "y"), (None, 0, "user", "z"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("turns", F.lit("clash"))
    made = chat.formatted(frame)
    back = {r.conv_id: [tuple(t) for t in r.turns] for r in made.select("conv_id", chat.turns(F.col("formatted")).alias("turns")).collect()}
    assert back[1] == [("system", ""), ("user", "a\\<|im_end|>b"), ("user", "<\\|x"), ("assistant", "é<|turn|>😀"), ("assistant", "\n")]
    assert back[2] == [("", "x"), ("assistant", "y"), ("assistant", "y"), ("assistant\n<|im_start|>", "y")] and back[None] == [("user", "z")]
    assert {r.conv_id: r.loss_chars for r in chat.digests(made).collect()} == {1: 11, 2: 2, None: 0}
    assert made.where("conv_id = 1").first().formatted.count("<|im_start|>") == 3
    assert chat.formatted(frame.limit(0)).collect() == []


def page(body, nav="Home"):
    return f"<html><head><title>T</title><script>if (a<b) x='</p>'</script></head><body><nav><a href=/>{nav}</a></nav>{body}<footer>Imprint</footer></body></html>"


def test_html(spark):
    bodies = [f"<article class=post><h1>Title {i}</h1><p>Some &amp; <b>bold</b> text {i}<p>second<br>line &eacute;&#x41;<div class='comments'><p>Nice!</p></div><aside>Ad</aside></article>" for i in range(6)]
    rows = [(i, f"http://h.org/{i}", page(b)) for i, b in enumerate(bodies)]
    rows += [(10, None, None), (11, "x", ""), (12, "http://h.org/12", page("<article><p>cut off <b").split("</body>")[0].split("<footer>")[0]), (13, "http://one.org/", page("<main><p>lone page</p></main><div id=cookie-notice>Cookies</div>"))]
    rows += [(20 + i, f"http://plain.org/{i}", page(f"<div><p>Plain words number {i} of this page</p></div><div class=sidebar>Links {i}</div>")) for i in range(6)]
    rows += [(0, "http://h.org/0", page(bodies[0]))]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("host", F.lit(1))
    found = {r.page_id: r.text for r in template.extracted(frame).collect()}
    for i in range(6):
        assert found[i] == f"Title {i} Some & bold text {i} second line éA"
        assert found[20 + i] == f"Plain words number {i} of this page"
    assert found[10] == found[11] == "" and found[12].startswith("cut off")
    assert found[13] == "lone page"
    assert template.extracted(frame.limit(0)).collect() == []


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_take_any_rows(spark, tmp_path, docs, nothing, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    spark.createDataFrame([(1, 1, 0), (7, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "word1x1 word2x2 word3x3 word4x4")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = stage(spark, docs, str(tmp_path))
    found = rows.collect()
    assert {r.doc_id for r in found} <= {i for i, _ in ROWS}
    if name != "packing":
        assert rows.columns == docs.columns
        assert None in {r.doc_id for r in found}
    if name == "near dedup":
        assert sorted((r.doc_id or 0) for r in found) == sorted((i or 0) for i in {i for i, _ in ROWS} - {2, 3, 8, 10})
    assert stage(spark, nothing, str(tmp_path)).collect() == []


def extracted_texts(spark, rows):
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in template.extracted(frame).collect()}


def test_html_template_decides_inside_an_article(spark):
    """An unmarked box that all articles of a host repeat is template text, though it stands in the article."""
    body = "<article><h1>Title {0}</h1><p>Words of page {0} alone<p>and {0} more<div class=box><b>Read our magazine</b> every week</div></article>"
    found = extracted_texts(spark, [(i, f"http://box.org/{i}", page(body.format(i))) for i in range(6)])
    assert found == {i: f"Title {i} Words of page {i} alone and {i} more" for i in range(6)}


def test_html_classes_hold_what_goes_together(spark):
    """Texts that are frequent, but neither on the same pages as others nor in one order with them, are no template."""
    def moving(i):
        parts = ["<div class=up>The box says so</div>", f"<div class=own><h2>Words</h2><p>Page {i} alone has these</p></div>"]
        return f"<div class=all>Lead of page {i} in many words" + "".join(parts[::-1] if i % 2 else parts) + "</div>"

    found = extracted_texts(spark, [(i, f"http://move.org/{i}", page(moving(i))) for i in range(8)])
    for i in range(8):
        said = ["The box says so", f"Page {i} alone has these"]
        assert found[i] == " ".join([f"Lead of page {i} in many words", *(said[::-1] if i % 2 else said)])

    def frequent(i, name):
        return f"Sentence {name}" if (i + ord(name)) % 3 else f"Words that page {i} has by itself at {name}"

    rows = [(i, f"http://freq.org/{i}", page("".join(f"<div class={name}>{frequent(i, name)}</div>" for name in "xyz"))) for i in range(9)]
    assert extracted_texts(spark, rows) == {i: " ".join(frequent(i, name) for name in "xyz") for i in range(9)}


def test_html_repeated_pages_count_once(spark):
    """A host without article or main whose pages were all crawled twice, and one whose pages are mostly copies of one."""
    plain = "<div><p>Plain words number {0} of this page</p><p>and more {0}</p></div>"
    rows = [(10 * k + i, f"http://twice.org/{i}", page(plain.format(i))) for i in range(6) for k in range(2)]
    rows += [(100 + i, f"http://copied.org/{i}", page(plain.format(max(0, i - 20)))) for i in range(26)]
    found = extracted_texts(spark, rows)
    for page_id, text in found.items():
        i = page_id % 10 if page_id < 100 else max(0, page_id - 120)
        assert text == f"Plain words number {i} of this page and more {i}"


def test_toxic_sample_goes_on_after_a_long_document(spark):
    """The first document by hash does not fit; the next ones do. A rare label is in a sample smaller than the others of its like."""
    ids = [r.id for r in spark.range(1, 400).withColumnRenamed("id", "doc_id").where(~toxicity.held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id")).select(F.col("doc_id").alias("id")).collect()]
    labels = spark.createDataFrame([(i, int(k == len(ids) - 1)) for k, i in enumerate(ids)], "doc_id long, toxic int")
    rows = [(i, "word " * (2000 if k in (0, 5) else 10)) for k, i in enumerate(ids)]
    sample = toxicity.sampled(spark.createDataFrame(rows, "doc_id long, text string"), labels, sample=50, sample_bytes=4000).toPandas()
    # The 50 first of the plain label without the two that do not fit, and the one of the other.
    assert sorted(sample["toxic"]) == [0] * 48 + [1] and sum(map(len, sample["text"])) == 49 * 50
    only = toxicity.sampled(spark.createDataFrame([(ids[-1], "word " * 2000), (ids[1], "word")], "doc_id long, text string"), labels, sample_bytes=4000).toPandas()
    assert sorted(only["toxic"]) == [0, 1]


def test_toxicity_fit_equals_a_plain_one(spark):
    """The same likelihood, its slopes by hand for each sentence, the same steps."""
    draw = np.random.default_rng(8)
    words = [f"w{i}" for i in range(30)] + ["nasty"]
    rows = []
    for i in range(60):
        text = ". ".join(" ".join(draw.choice(words[:30], 5)) for _ in range(3))
        rows.append((i, int(i % 3 == 0), (text + (". nasty w1 nasty" if i % 3 == 0 and i % 9 else "")).encode()))
    model = toxicity.fit(spark.createDataFrame(rows, "doc_id long, toxic int, text binary").repartition(3), features=6, rounds=40)
    docs = [([[n for w in s for n in toxicity.features_of(w)] for s in toxicity.sentence_words(t)], y) for _, y, t in rows]
    rate, gaps = sum(y for _, y in docs) / len(docs), {}
    for number in {n for d, _ in docs for s in d for n in s}:
        inside = [y for d, y in docs if any(number in s for s in d)]
        df, bad = len(inside), sum(inside)
        if df >= 2:
            gaps[number] = abs(bad - df * rate) / np.sqrt(df * rate * (1 - rate) * (1 - df / (len(docs) + 1)) + 1)
    chosen = [n for n in sorted(gaps, key=lambda n: (-gaps[n], n))[:6] if gaps[n] >= 2.5]
    assert set(model.weights) == set(chosen) and chosen
    point, first, second = np.append(np.zeros(len(chosen)), -7.0), 0, 0
    for step in range(1, 41):
        slopes = np.append(1e-4 * point[:-1], 0.0)
        for sentences, toxic in docs:
            counts = [np.array([s.count(n) for n in chosen] + [1.0]) for s in sentences]
            chance = [1 / (1 + np.exp(-c @ point)) for c in counts]
            clean = min(np.prod([1 - p for p in chance]), np.exp(-1e-6))
            for c, p in zip(counts, chance):
                slopes += c * p * (-clean / (1 - clean) if toxic else 1.0) / len(docs)
        first, second = 0.9 * first + 0.1 * slopes, 0.99 * second + 0.01 * slopes**2
        point = point - 0.15 / (1 + step / 100) * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    assert model.bias == pytest.approx(point[-1], abs=1e-6)
    assert [model.weights[n] for n in chosen] == pytest.approx(point[:-1].tolist(), abs=1e-6)
