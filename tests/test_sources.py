import json
import os
import random

from pyspark.sql import functions as F

from conftest import report
from transitlens.sources.text import split_documents
from transitlens.sources import corrupt_reports, parse_report_lines, parse_reports, read_report_lines, tokenize_lines


def test_tokenizer_splits_on_whitespace(spark, landing):
    a, b = report(1, 100), report(2, 200)
    path = landing([[f"  {a}   {b}", "", report(3, 300)]])
    toks = tokenize_lines(read_report_lines(spark, path)).collect()
    assert [t.token for t in toks] == [a, b, report(3, 300)]


def test_parse_fields_and_types(spark, reports_of):
    r = reports_of([report("v1", 1703181905807, bearing=315.5, delay=12.5, ltype=5, stop=77)]).collect()[0]
    assert (r.id, r.bearing, r.delay, r.lastupdate, r.ltype, r.laststopid) == ("v1", 315.5, 12.5, 1703181905807, 5, "77")


def test_empty_delay_is_null_not_corrupt(spark, landing):
    doc = report("v", 1, delay=0).replace('"delay":0', '"delay":""')
    lines = read_report_lines(spark, landing([[doc]]))
    assert parse_reports(lines).collect()[0].delay is None
    assert corrupt_reports(lines).count() == 0


def test_corrupt_input_is_kept_aside(spark, landing):
    good = report("a", 1)
    truncated = good[: len(good) // 2]
    apostrophe = report("O'Brien", 2)
    single_quoted = report("q", 3).replace('"', "'")
    lines = read_report_lines(spark, landing([[good, truncated, apostrophe, single_quoted]]))
    ok = sorted(r.id for r in parse_reports(lines).collect())
    assert ok == ["O'Brien", "a", "q"]
    bad = corrupt_reports(lines).collect()
    assert [r.value for r in bad] == [truncated]


def test_missing_attributes_counts_as_corrupt(spark, landing):
    lines = read_report_lines(spark, landing([["{}", report("x", 1)]]))
    p = parse_report_lines(lines).where(F.col("_corrupt_record").isNotNull()).count()
    assert p == 1


def test_read_requires_path(spark):
    import pytest

    with pytest.raises(ValueError):
        read_report_lines(spark, "")


def test_report_source_modes_and_tokenizing(spark, landing):
    import pytest

    from transitlens.sources import report_source

    a, b, c = report("a", 1), report("b", 2), report("c", 3)
    spaced = report("d", 4).replace(":", ": ").replace(",", ", ")
    path = landing([[f"{a} {b}", c, spaced]])
    assert sorted(r.id for r in report_source(spark, path).collect()) == ["a", "b", "c", "d"]
    assert sorted(r.id for r in report_source(spark, path, mode="bulk", split="whitespace").collect()) == ["a", "b", "c"]
    # one document per line: the JSON parser keeps the first document only
    assert sorted(r.id for r in report_source(spark, path, split="none").collect()) == ["a", "c", "d"]
    with pytest.raises(ValueError):
        report_source(spark, path, mode="files")
    with pytest.raises(ValueError):
        report_source(spark, None)
    with pytest.raises(ValueError):
        report_source(spark, path, split="lines")


def _equal_times(path):
    for f in os.listdir(path):
        os.utime(os.path.join(path, f), (1_600_000_000, 1_600_000_000))


def test_numbers_of_arrival_are_unique_over_equal_times_and_split_files(spark, landing):
    from transitlens.sources import report_source

    # two documents a line, in files of one time; the first file is cut into many splits
    docs = [report(f"v{i}", 1000) for i in range(600)]
    pairs = [f"{a} {b}" for a, b in zip(docs[::2], docs[1::2], strict=True)]
    path = landing([pairs[:250], pairs[250:270], pairs[270:]])
    _equal_times(path)
    name = "spark.sql.files.maxPartitionBytes"
    before, few = spark.conf.get(name), "3000"
    spark.conf.set(name, few)
    spark.conf.set("spark.sql.files.openCostInBytes", "100")
    try:
        r = report_source(spark, path)
        assert r.rdd.getNumPartitions() > 5
        got = [(x.seq, x.id) for x in r.collect()]
        lines = [(x.seq, x.value) for x in read_report_lines(spark, path).collect()]
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.set(name, before)
    assert sorted(got) == [(i, f"v{i}") for i in range(600)]
    assert sorted(lines) == list(enumerate(pairs))


def test_streamed_documents_get_unique_numbers_in_their_order(spark, landing, tmp_path):
    from transitlens import streaming

    docs = [report(f"v{i}", 1000) for i in range(40)]
    same = report("same", 1)
    path = landing([[f"{docs[i]} {docs[i + 1]}" for i in range(0, 20, 2)], docs[20:] + [same, same]])
    _equal_times(path)
    out = str(tmp_path / "numbers")

    def write(batch, batch_id):
        batch.select("seq", "id").write.mode("append").parquet(out)

    streaming.run_foreach(streaming.report_stream_from_text(spark, path, max_files_per_trigger=2), "t-numbers", write)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert [i for _, i in got] == [f"v{i}" for i in range(40)] + ["same", "same"]
    assert len({s for s, _ in got}) == 42


def _documents(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq bigint, value string")
    return [(r.seq, r.token) for r in split_documents(df).orderBy("seq", "pos").collect()]


def test_documents_are_cut_at_the_closing_brace_only(spark):
    whole = '{"id":"a} {b"}'
    assert _documents(spark, whole) == [(0, whole)]
    a, b = '{"a":{"x":"}{"}}', "{'q':'it\\'s {'}"
    assert _documents(spark, f"{a}{b}", f" {a}  {b} ", f"{a}\n{b}") == [(i, d) for i in range(3) for d in (a, b)]
    # text around, and a document that is never closed
    assert _documents(spark, f"noise {a} more", '{"cut":"of') == [(0, "noise"), (0, a), (0, "more"), (1, '{"cut":"of')]
    assert _documents(spark, "", "  ", None) == []
    long = '{"t":"' + "x{}\\\"" * 50_000 + '"}'
    assert _documents(spark, long + long) == [(0, long), (0, long)]


def test_split_documents_agree_with_a_decoder(spark):
    r = random.Random(7)
    alphabet = ['{', '}', '"', "'", "\\", " ", "a", "\n", "é", ":", ","]

    def value(depth):
        if depth == 0 or r.random() < 0.4:
            return r.choice([None, 1, -2.5, True, "".join(r.choices(alphabet, k=r.randint(0, 8)))])
        if r.random() < 0.3:
            return [value(depth - 1) for _ in range(r.randint(0, 3))]
        return {"".join(r.choices(alphabet, k=3)) + str(i): value(depth - 1) for i in range(r.randint(0, 3))}

    texts, want = [], []
    for i in range(300):
        docs = [json.dumps({"k": value(4)}, indent=r.choice([None, None, 2])) for _ in range(r.randint(1, 4))]
        text = "".join(d + r.choice(["", " ", "\n", " \t "]) for d in docs)
        texts.append(text)
        decoder, at = json.JSONDecoder(), 0
        while at < len(text):
            _, end = decoder.raw_decode(text, at)
            want.append((i, text[at:end]))
            at = end + len(text[end:]) - len(text[end:].lstrip())
    assert _documents(spark, *texts) == want


def test_documents_over_several_lines(spark, landing):
    from transitlens.sources import report_source

    pretty = json.dumps(json.loads(report("a", 1)), indent=2)
    path = landing([[pretty, report("b", 2)], [report("c", 3) + pretty.replace('"a"', '"d"')]])
    got = sorted((x.seq, x.id) for x in report_source(spark, path, split="files").collect())
    assert got == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]
