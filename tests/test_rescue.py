"""Landing that loses nothing: lines, and files by content."""

import os

import pytest

from clinilake.lake import Lake
from clinilake.plans import jobs
from clinilake.sources import land_lines, parse_lines, rebuilt
from clinilake.streaming import land_files, landed_files

SCHEMA = "id long, name string, day date"
JSON_LINES = ['{"id":1,"name":"a","day":"2024-01-02"}', '{"id":"x","name":"b"}', '{"id":2,"extra":{"k":[1]},"name":"c"}',
              "{broken", "", None, "{}", "[1]", '{"id":3.5,"name":7}', '{"id": 4}', '{"id":5,"id":6}', '{"id":null}',
              '"t"', '{"id":7,"name":"ü"}', '{"id":1' + "0" * 30 + "}", '{"day":"not a day","name":""}', " " * 3000]
CSV_LINES = ["1,a,2024-01-02", "x,b,", '2,"q,r",2024-05-05,extra', "", "a", None, " 3 ,c,2024-01-01", "4,,", '"5",x,',
             "6,é,soon", ",,", "7;8"]


@pytest.mark.parametrize("fmt, lines", [("json", JSON_LINES), ("csv", CSV_LINES)])
def test_every_line_can_be_rebuilt(spark, fmt, lines):
    df = spark.createDataFrame(list(enumerate(lines)), "n int, value string")
    landed = parse_lines(df, fmt, SCHEMA)
    assert landed.columns == ["id", "name", "day", "_rescued", "_raw", "n"]
    got = {r.n: r.line for r in landed.select("n", rebuilt(landed, fmt, SCHEMA).alias("line")).collect()}
    assert got == dict(enumerate(lines))


def test_what_does_not_fit_is_named(spark):
    df = spark.createDataFrame([(x,) for x in JSON_LINES], "value string")
    got = {r._raw: (r.id, r.name, r._rescued) for r in parse_lines(df, "json", SCHEMA).collect() if r._rescued}
    assert got['{"id":"x","name":"b"}'] == (None, "b", {"id": "x"})
    assert got['{"id":2,"extra":{"k":[1]},"name":"c"}'] == (2, "c", {"extra": '{"k":[1]}'})
    assert got['{"day":"not a day","name":""}'] == (None, "", {"day": "not a day"})
    csv = spark.createDataFrame([("6,é,soon",)], "value string")
    assert parse_lines(csv, "csv", SCHEMA).first()._rescued == {"day": "soon"}


def test_odd_names_options_and_clashes(spark):
    df = spark.createDataFrame([('{"a.b":1,"c`d":"x"}', "kept"), ('{"a.b":"y"}', "kept")], "value string, fields string")
    landed = parse_lines(df, "json", "`a.b` int, `c``d` string")
    assert landed.columns == ["a.b", "c`d", "_rescued", "_raw", "fields"]
    assert [tuple(r)[:3] for r in landed.collect()] == [(1, "x", None), (None, None, {"a.b": "y"})]
    semi = spark.createDataFrame([("1;b;2024-01-01",)], "value string")
    options = {"sep": ";"}
    assert parse_lines(semi, "csv", SCHEMA, options=options).first()[:2] == (1, "b")
    with pytest.raises(ValueError, match="fields"):
        parse_lines(df, "json", "fields string")
    with pytest.raises(ValueError, match="fmt"):
        parse_lines(df, "xml", SCHEMA)
    assert parse_lines(df.limit(0), "json", SCHEMA).count() == 0


def test_land_bronze_with_a_schema(spark, scratch):
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.json", "w", encoding="utf-8") as f:
        f.write("\n".join(x for x in JSON_LINES if x) + "\n")
    lake = Lake(scratch)
    jobs.land_bronze(spark, lake, "json", f"{scratch}/in", "raw", schema=SCHEMA)
    landed = spark.read.parquet(lake.path("bronze", "raw"))
    assert sorted(r[0] for r in landed.select(rebuilt(landed, "json", SCHEMA)).collect()) == sorted(x for x in JSON_LINES if x)
    assert landed.select("_source_file").distinct().count() == 1
    assert land_lines(spark, "json", f"{scratch}/in", SCHEMA).count() == landed.count()


def _land(spark, scratch, **more):
    land_files(spark, f"{scratch}/in", f"{scratch}/landed", "files", f"{scratch}/ckpt", **more).awaitTermination()
    return sorted((os.path.basename(r.path), bytes(r.content)) for r in landed_files(spark, f"{scratch}/landed").collect())


def _put(scratch, name, text):
    os.makedirs(f"{scratch}/in", exist_ok=True)
    with open(f"{scratch}/in/{name}", "w", encoding="utf-8") as f:
        f.write(text)


def test_renamed_and_resent_files_land_once(spark, scratch):
    assert landed_files(spark, f"{scratch}/landed").count() == 0
    _put(scratch, "a.txt", "one")
    _put(scratch, "b.txt", "two")
    _put(scratch, "c.txt", "one")  # twice in one batch
    first = _land(spark, scratch)
    assert first == [("a.txt", b"one"), ("b.txt", b"two")]
    _put(scratch, "renamed.txt", "two")
    _put(scratch, "d.txt", "three")
    second = _land(spark, scratch, max_files_per_trigger=1)
    assert second == sorted([*first, ("d.txt", b"three")])
    assert _land(spark, scratch) == second


def test_a_batch_that_runs_again_lands_the_same(spark, scratch):
    _put(scratch, "a.txt", "one")
    _land(spark, scratch)
    _put(scratch, "b.txt", "two")
    _land(spark, scratch)
    # The last batch was written, but its commit was lost: the stream repeats it.
    commits = sorted(f for f in os.listdir(f"{scratch}/ckpt/commits") if f.isdigit())
    for f in (commits[-1], f".{commits[-1]}.crc"):
        if os.path.exists(f"{scratch}/ckpt/commits/{f}"):
            os.remove(f"{scratch}/ckpt/commits/{f}")
    assert _land(spark, scratch) == [("a.txt", b"one"), ("b.txt", b"two")]
