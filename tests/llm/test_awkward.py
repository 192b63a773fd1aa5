"""Every operator on awkward rows: nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from filewright.llm import bpe, decontam, embed, langid, linededup, ngram_join, pii, substring, toxicity, warc

DDL = "doc_id long, text string, lang string, source string, n_chars long, score double, id string, x int, __h string, tag string"
WORDS = " ".join(f"word{i}" for i in range(120))
LONG = "very long text " * 20_000
ROWS = [
    (1, WORDS, "en", "a", 1, 0.1, "i", 1, "h", "t"), (2, WORDS, "en", "a", 1, 0.1, "i", 1, "h", "t"), (2, WORDS, "en", "a", 1, 0.1, "i", 1, "h", "t"), (2, "another text under this id", "en", "a", 1, 0.1, "i", 1, "h", "t"),
    (3, None, "en", None, None, None, None, None, None, None), (4, "", None, "b", 0, None, None, None, None, None), (None, "no id here", "de", "b", 1, None, None, None, None, None),
    (5, LONG, "en", "b", 1, None, None, None, None, None), (6, "x" * 200_000, "de", "b", 1, None, None, None, None, None), (7, "1234 é中\U0001f600 \x00 \x1c \r\n\t", "fr", "c", 1, None, None, None, None, None), (-8, " \n ", "de", "b", 1, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DDL).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 0, 0), (2, 0, 0), (2, 1, 1), (5, 0, None), (None, 1, 1), (6, 1, 1), (99, 1, 1)], "doc_id long, quality int, toxic int")


def test_toxicity(docs, none, labels):
    out = toxicity.score(docs, labels, toxicity.default_held_out())
    rows = out.collect()
    assert len(rows) == len(ROWS) and out.columns == [*(c for c in docs.columns if c != "score"), "held_out", "score", "predicted"]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    assert toxicity.score(none, labels, toxicity.default_held_out()).count() == 0
    assert {round(r.score, 6) for r in toxicity.score(docs, labels.limit(0), toxicity.default_held_out()).collect()} == {0.5}


def test_language(docs, none):
    rows = langid.predict(docs, langid.default_held_out()).collect()
    assert len(rows) == len(ROWS)
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, -8)} == {"und"} and all(r.lang_pred in ("en", "de", "fr", "und") for r in rows)
    assert langid.predict(none, langid.default_held_out()).count() == 0
    assert {r.lang_pred for r in langid.predict(docs.withColumn("lang", F.lit(None).cast("string")), langid.default_held_out()).collect()} == {"und"}


def test_bpe(docs, none):
    def run(df):
        return bpe.encode(df, P.path("byte_bpe_50k.tiktoken"), P.PATTERN, keep_ids=True)

    rows = run(docs).collect()
    assert sorted((r.doc_id or 0, r.decoded_sha256) for r in rows) == sorted((r[0] or 0, hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in ROWS)
    assert all(r.n_tokens == len(r.ids) for r in rows) and run(none).count() == 0


def test_substring(docs, none):
    rows = substring.remove(docs).collect()
    assert len(rows) == len(ROWS)
    got = sorted((r.doc_id or 0, r.n_words, r.n_removed) for r in rows)
    assert got == sorted([(1, 120, 0), (2, 120, 120), (2, 120, 120), (2, 5, 0), (3, 0, 0), (4, 0, 0), (0, 3, 0), (5, 60_000, 0), (6, 1, 0), (7, 4, 0), (-8, 0, 0)])
    assert substring.remove(none).count() == 0


def test_join(docs, none):
    got = [(r.doc_id or 0, r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()]
    assert sorted(got, key=str) == sorted([(1, 118, 1), (2, 118, 1), (2, 118, 1), (2, 3, 1), (3, 0, 3), (4, 0, 4), (0, 1, None), (5, 3, 5), (6, 1, 6), (7, 2, 7), (-8, 0, -8)], key=str)
    by = {(r[0], r[1]): r[2] for r in got}
    assert by[1, 118] == by[2, 118] == 1 and by[3, 0] == 3 and by[4, 0] == 4 and by[-8, 0] == -8 and by[0, 1] is None
    assert ngram_join.join(none).count() == 0


def test_pii(docs, none):
    rows = pii.find(docs).collect()
    assert len(rows) == len(ROWS) and all(r.spans == "" for r in rows) and pii.find(none).count() == 0


def test_line_dedup(docs, none, spark):
    out = linededup.drop_boilerplate(docs.withColumn("n_lines", F.lit("old")))
    assert out.count() == len(ROWS) and out.columns.count("n_lines") == 1 and linededup.drop_boilerplate(none).count() == 0
    pages = spark.createDataFrame([(i, f"menu\nown {i}\n\nmenu", "h") for i in range(25)] + [(30, "menu", None), (31, None, "h"), (32, "menu", "small")], "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in linededup.drop_boilerplate(pages).collect()}
    assert rows[3].text == "own 3\n" and (rows[3].n_lines, rows[3].n_dropped) == (4, 2)
    assert rows[30].text == "menu" and rows[31].text is None and rows[31].n_lines == 0 and rows[32].text == "menu"


def test_line_dedup_on_small_hosts(spark):
    pages = [(100 * n + i, f"menu {n}\nown {n} {i}", f"h{n}") for n in (1, 2, 9, 19) for i in range(n)]
    pages += [(5000 + i, f"{'pair' if i < 2 else 'alone'} {i // 2}\nown {i}", "h20") for i in range(20)]
    df = spark.createDataFrame(pages, "doc_id long, text string, source string")
    rows = {r.doc_id: r for r in linededup.drop_boilerplate(df).collect()}
    for i, text, host in pages:
        plate = host in ("h2", "h9", "h19")
        assert (rows[i].text, rows[i].n_dropped) == ((text.split("\n")[1], 1) if plate else (text, 0)), (i, host)
    spread = {r.doc_id: r for r in linededup.drop_boilerplate(df.withColumn("x", F.lit(1)), broadcast_lines=0).drop("x").collect()}
    assert spread == rows  # too many lines to broadcast


def test_decontamination(docs, none, spark):
    items = spark.createDataFrame([(1, " ".join(f"WORD{i}," for i in range(30, 60))), (2, None), (3, ""), (4, "no id"), (5, "unseen words of another kind entirely")], "item_id long, text string")
    rows = decontam.find(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 4), (1, 1), (2, 1), (2, 1)]
    kept = decontam.drop_contaminated(docs, items)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [-8, 2, 3, 4, 5, 6, 7]
    assert decontam.find(none, items).count() == 0 and decontam.find(docs, items.limit(0)).count() == 0 and decontam.drop_contaminated(docs, items.limit(0)).count() == len(ROWS)


def test_embeddings(spark):
    ddl = "vec_id long, embedding array<float>, label int, digest int"
    one, near = [1.0, 0.0, 0.0], [1.0, 0.1, 0.0]
    rows = [(5, one, 1, 1), (3, near, 1, 1), (5, one, 1, 1), (9, [0.0, 1.0, 0.0], 1, 1), (10, None, 1, 1), (11, [0.0, 0.0, 0.0], 1, 1), (12, [1.0, None, 0.0], 1, 1), (13, [float("nan"), 1.0, 0.0], 1, 1), (14, [float("inf"), 0.0, 0.0], 1, 1), (15, [1.0, 0.0], 1, 1), (16, [], 1, 1), (None, [0.0, 1.0, 0.01], 1, 1)]
    out = embed.near_duplicates(spark.createDataFrame(rows, ddl)).collect()
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in out if r.vec_id is not None)
    assert got == [(3, 2, 3, True), (5, 2, 3, False), (5, 2, 3, False), (9, 1, 9, True)] + [(i, 0, i, True) for i in (10, 11, 12, 13, 14, 15, 16)]
    assert [(r.n_links, r.component_id, r.kept) for r in out if r.vec_id is None] == [(1, None, False)]
    assert embed.near_duplicates(spark.createDataFrame([], ddl)).count() == 0
    assert embed.near_duplicates(spark.createDataFrame([(1, None, 1, 1)], ddl)).first().kept


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc(spark, compression):
    same = "<p>" + "same " * 40
    rows = [(7, "http://a/\r\nx%y", same), (2, None, same), (9, "u", same), (4, "u", None), (5, "u", ""), (6, "u", "short"), (8, "u", "short"), (None, "u", same), (3, "u", "é" * 70), (3, "u", "é" * 70), (10, "u", "z" * 300_000)]
    pages = spark.createDataFrame([(*r, 1, "w") for r in rows], "page_id long, url string, html string, payload int, record_type string")
    out = warc.round_trip(pages, compression=compression).collect()
    first = {same: 2}
    expect = sorted((i or 0, len((h or "").encode()), hashlib.sha256((h or "").encode()).hexdigest(), "revisit" if h == same and i != 2 else "response", first.get(h) if i != 2 else None) for i, _, h in rows)
    assert sorted((r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out) == expect
    planned = [sorted(map(repr, warc.plan_records(pages, broadcast_copies=n).collect())) for n in (0, 1000)]  # a long list of copies, a short one
    assert planned[0] == planned[1] and len(planned[0]) == len(rows)
    assert warc.round_trip(pages.limit(0), compression=compression).count() == 0


def test_warc_reader(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"http://h/{i}%", "b" * (i + 1)) for i in range(20)], "page_id long, url string, html string")
    warc.write_pages(pages.where("page_id < 9"), f"file://{tmp_path}/w")
    warc.write_pages(pages.where("page_id >= 9"), f"file://{tmp_path}/w")
    back = spark.read.format("warc").load(f"file://{tmp_path}/w")
    assert {r.target_uri for r in back.collect()} == {f"http://h/{i}%" for i in range(20)}
    one = back.where("record_type = 'response' and target_uri = 'http://h/4%'")
    assert one.count() == 1 and one.first().payload == b"bbbbb"
    reader = warc.WarcReader(f"file://{tmp_path}/w", {"partitionBytes": "1"})
    left = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_length",), 3)]))
    assert len(left) == 1 and sum(b.num_rows for p in reader.partitions() for b in reader.read(p)) == 0 and len(reader.partitions()) > 1
    # an archive written elsewhere: its URIs are given back as they are, and predicates see them so
    foreign = tmp_path / "foreign.warc"
    foreign.write_bytes(b"".join(warc.record("response", f"urn:x:{i}", uri, "0", None, 2, b"ok") for i, uri in enumerate(["http://a/x%25y", "http://a/%0Ab", "http://a/c%"])))
    back = spark.read.format("warc").load(f"file://{foreign}")
    assert {r.target_uri for r in back.collect()} == {"http://a/x%25y", "http://a/%0Ab", "http://a/c%"}
    assert back.where("target_uri = 'http://a/x%25y'").count() == 1 and back.where("target_uri = 'http://a/x%y'").count() == 0
    bare = spark.read.format("warc").option("payload", "false").load(f"file://{tmp_path}/w").collect()
    assert all(r.payload is None and r.payload_length > 0 for r in bare)


def test_pipeline_stages(docs, none, spark):
    """Every stage on awkward rows: its columns, named like what stages add too, are those that came in."""
    import corpus_pipeline as pipeline

    small = "/root/testdata/sf0.001"
    odd = docs.withColumn("held_out", F.lit("mine")).withColumn("n_lines", F.lit(5)).withColumn("component_id", F.lit(1.5))
    ids = {name: sorted(r.doc_id or 0 for r in stage(spark, odd, small).collect()) for name, stage in pipeline.STAGES[:-1]}
    everything = sorted(r[0] or 0 for r in ROWS)
    assert ids["line_dedup"] == everything and set(ids["toxicity"]) <= set(everything) and {0, 3, 4, 5} <= set(ids["toxicity"])
    # the second text of id 2 and its copies of id 1 go together
    assert ids["ngram_jaccard_join"] == [i for i in everything if i != 2] and ids["benchmark_decontamination"] == everything
    for name, stage in pipeline.STAGES[:-1]:
        out = stage(spark, odd, small)
        assert out.columns == odd.columns, name
        assert {(r.held_out, r.n_lines, r.component_id) for r in out.collect()} == {("mine", 5, 1.5)}, name
        assert stage(spark, none, small).count() == 0, name
    last = pipeline.STAGES[-1][1]
    assert last(spark, odd, small).count() == len(ROWS) and last(spark, none, small).count() == 0
