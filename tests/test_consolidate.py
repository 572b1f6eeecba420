"""Consolidation against a plain reading of the same files."""

import json
from datetime import datetime

from pyspark.sql import functions as F

from docloom.operators import consolidate as c


def fixture(spark):
    t = [datetime(2020, 1, d) for d in range(1, 9)]
    line = lambda k, x="v": json.dumps({"record_id": k, "text": x})
    files = [
        (1, "J1", "/a", line("k1") + "\n" + line("k2") + "\n\n", t[0]),
        (2, "J1", "/b", line("k1", "new"), t[1]),
        (3, "J2", "/c", line("k1", "not vouched"), t[5]),
        (4, "J2", "/d", line("k3") + "\n" + line("k4")[:-4], t[2]),
        (5, "J2", "/e", line("k3"), t[2]),
        (6, "J1", "/f", None, t[3]), (7, "J1", "/g", "", t[3]),
        (8, "J1", "/h", '[1]\n"x"\n{"a": 1} junk\n{"record_id": "k5"}{"record_id": "k6"}\n{"record_id": null}\n \n' + line("k7"), None),
        (9, "J2", "/a", line("k8"), t[3]), (10, "J1", "/i", '{"record_id": "k9", "text": "v", "x": 1, "x": 2}', t[4]),
    ]
    listed = [
        ("J1", "error", [("/a", "processed"), ("/a", "processed"), ("/b", " PROCESSED "), ("/f", "processed"), ("/g", "processed"), ("/h", "Processed"), ("/gone", "processed"), ("/i", "processed")]),
        ("J2", "processed", [("/c", "running"), ("/c", None), ("/d", "processed"), ("/e", "processed")]),
    ]
    f = spark.createDataFrame([(*x, "extra") for x in files], "file_id bigint, job_id string, path string, content string, written_at timestamp, record_id string")
    jobs = spark.createDataFrame(
        [(j, s, [(p, None, p, x) for p, x in fs]) for j, s, fs in listed],
        "job_id string, status string, files_output array<struct<filename: string, input: string, path: string, status: string>>",
    )
    return f, jobs


def test_current_records(spark, tmp_path):
    f, jobs = fixture(spark)
    vouched = c.vouched_files(f, jobs)
    merged = c.write_consolidated(vouched, f"file://{tmp_path}/a", target_bytes=60, range_bytes=100, run_bytes=1)
    want = [("k1", 2), ("k2", 1), ("k3", 5), ("k7", 8), ("k9", 10)]
    assert sorted((r.record_id, r.file_id) for r in c.current_records(merged).collect()) == want
    assert merged.count() == c.lines_of(vouched).count() == 7  # duplicates are kept
    meta = sorted(c.range_metadata(merged).collect(), key=lambda r: r.out_file)
    assert sum(r.n_rows for r in meta) == 7 and all(r.min_key <= r.max_key for r in meta) and len(meta) > 1
    assert all(a.max_key <= b.min_key for a, b in zip(meta, meta[1:]))
    newest = {r.record_id: json.loads(r.line)["text"] for r in c.current_lines(merged).collect()}
    assert newest["k1"] == "new" and set(newest) == {k for k, _ in want}
    none = c.write_consolidated(c.vouched_files(f.limit(0), jobs), f"file://{tmp_path}/b")
    assert c.current_records(none).count() == 0


def test_keys_of_lines(spark):
    rows = ['{"record_id": "a", "x": 1, "x": 2}', '{"record_id": "a", "record_id": "b"}', '{"record_id": 7}', "{'record_id': 'a'}", '{"record_id": "a", "n": NaN}',
            '{"record_id": "a"} {}', '{"record_id": "a"}, {"record_id": "b"}', ' {"record_id": "a", "t": {"record_id": "z"}} ', '["record_id"]', '{"record_id": "a"', "", None,
            '{"record_id": "' + "k" * 10 + '", "t": "' + "long " * 100_000 + '"}']
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, line string")
    got = [r.k for r in df.select("i", c.record_key(F.col("line")).alias("k")).orderBy("i").collect()]
    assert got == ["a", "b", "7", None, None, None, None, "a", None, None, None, None, "k" * 10]


def test_hot_key_is_spread_and_every_row_is_merged_in_order(spark):
    rows = [("hot", datetime(2020, 1, 1 + i % 9), i, 0, "x" * 50) for i in range(900)] + [(f"k{i % 250}", None, i, i % 3, "y" * (i % 7)) for i in range(300)] + [("big", None, 1, 1, "z" * 9000)]
    lines = spark.createDataFrame(rows, c.LINES).repartition(5)
    merged = c.merge_runs(lines, target_bytes=5000, range_bytes=9000, run_bytes=4000).cache()
    out = merged.collect()
    assert sorted((r.record_id, r.written_at, r.file_id, r.line_no, r.line) for r in out if r.written_at) == sorted(r for r in rows if r[1])
    assert sorted((r.record_id, r.file_id, r.line_no, r.line) for r in out) == sorted((r[0], *r[2:]) for r in rows)
    assert merged.where("record_id = 'hot'").selectExpr("substring(out_file, 1, 12) p").distinct().count() > 2
    by_file = {}
    for r in out:
        by_file.setdefault(r.out_file, []).append(c.sort_key(r.record_id, r.written_at and int(r.written_at.timestamp() * 1e6), r.file_id, r.line_no))
    ordered = [by_file[k] for k in sorted(by_file)]
    assert all(x == sorted(x) for x in ordered) and all(a[-1] <= b[0] for a, b in zip(ordered, ordered[1:]))
    meta = {r.out_file: r for r in c.range_metadata(merged).collect()}
    assert all(r.n_bytes <= 5000 or r.n_rows == 1 for r in meta.values()) and sum(r.n_rows for r in meta.values()) == len(rows)
    got = {r.record_id: r.file_id for r in c.current_records(merged).collect()}
    assert got["hot"] == max(i for i in range(900) if i % 9 == 8) and len(got) == 252
