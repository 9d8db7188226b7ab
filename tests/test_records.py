"""Record-safe splits: one file in many tasks, quoted line breaks never torn, stable places, refusals."""

import csv
import os
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources import files, records

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "name", "note")])


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def rows_of(n, seed, breaks):
    rng = random.Random(seed)
    words = ["plain", 'q"uote', "a,b", " spaces ", "", '"', 'x"",y', "é日本", "'", "tab\t"]
    if breaks:
        words += ["line\nbreak", '"\n"', "\n", "a\r\nb", "long\n" * 900, "," * 50 + "\n\n" + '""']
    return [(str(i), rng.choice(words), rng.choice(words) or None) for i in range(n)]


def write(rows, name="x.csv", folder=None, end="\n", header=("id", "name", "note")):
    folder = folder or tempfile.mkdtemp(prefix="ledgerline-records-")
    with open(os.path.join(folder, name), "w", newline="", encoding="utf-8") as f:
        out = csv.writer(f, lineterminator=end)
        out.writerow(header)
        out.writerows([["" if v is None else v for v in r] for r in rows])
    return os.path.join(folder, name)


def expected(rows):
    return Counter((i, a or None, b or None) for i, a, b in rows)


@pytest.mark.parametrize("breaks", [False, True])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_file_many_tasks_same_rows(spark, small_splits, breaks, end):
    rows = rows_of(900, 1, breaks)
    path = write(rows, end=end)
    found = records.layout(spark, path)
    assert found.n_splits > 5 and found.all_whole == (not breaks)
    df = files.read_csv(spark, path, SCHEMA)
    if not breaks:
        assert df.rdd.getNumPartitions() > 5
    assert Counter(map(tuple, df.collect())) == expected(rows)
    if end == "\n":  # as a whole, Spark takes the line end of the file for those inside quotes too
        assert Counter(map(tuple, files.read_csv(spark, path, SCHEMA, multi_line=True).collect())) == expected(rows)


def test_a_record_over_several_splits(spark, small_splits):
    rows = [("1", "a", "b"), ("2", "x\n" * 5000, '"\n"' * 1000), ("3", "c", "d\ne")]
    path = write(rows)
    assert records.layout(spark, path).n_splits > 5
    assert Counter(map(tuple, files.read_csv(spark, path, SCHEMA).collect())) == expected(rows)


@pytest.mark.parametrize("breaks", [False, True])
def test_ordinals_follow_the_file_under_any_splits(spark, breaks):
    folder = tempfile.mkdtemp(prefix="ledgerline-records-")
    parts = [rows_of(n, n, breaks) for n in (150, 1, 0, 90)]
    for k, rows in enumerate(parts):
        write(rows, f"part-{k}.csv", folder)
    seen = []
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for size in ("900", "5000", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        seen.append(sorted((r["place"], r["id"], r["name"]) for r in files.read_csv(spark, folder, SCHEMA, ordinal="place").repartition(3).collect()))
    for k, v in old.items():
        spark.conf.set(k, v)
    assert seen[0] == seen[1] == seen[2]
    assert [r[1] for r in seen[0]] == [i for rows in parts for i, _, _ in rows]  # files by name, rows in file order
    assert len({r[0] for r in seen[0]}) == len(seen[0])


@pytest.mark.parametrize("text", ['id,name,note\n1,5" disk,x\n2,b,c\n', 'id,name,note\n1,"a"b,x\n', 'id,name,note\n1,"open,x\n2,b,c\n', 'id,name,note\r1,"a\nb",c\r'])
def test_other_quoting_is_refused_not_torn(spark, text):
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-records-"), "x.csv")
    with open(path, "w", newline="") as f:
        f.write(text)
    with pytest.raises(Exception, match="multi_line=True"):
        files.read_csv(spark, path, SCHEMA).collect()


def test_headers_must_agree(spark):
    path = write(rows_of(3, 1, True))
    write([("1", "a\nb", "c")], "y.csv", os.path.dirname(path), header=("name", "id", "note"))
    with pytest.raises(ValueError, match="header"):
        files.read_csv(spark, os.path.dirname(path), SCHEMA, "t", ordinal="o").collect()


def test_no_text_is_shuffled_without_line_breaks(spark):
    path = write(rows_of(50, 2, False))
    for options in ({}, {"ordinal": "o"}):
        plan = files.read_csv(spark, path, SCHEMA, **options)._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(file" not in plan


def test_empty_files_and_blank_lines(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerline-records-"), "x.csv")
    with open(path, "w") as f:
        f.write('id,name,note\n\n1,a,b\n   \n2,"c\nd",e\n\n')
    assert [tuple(r) for r in files.read_csv(spark, path, SCHEMA).orderBy("id").collect()] == [("1", "a", "b"), ("2", "c\nd", "e")]
    with open(path, "w") as f:
        f.write("id,name,note\n")
    assert files.read_csv(spark, path, SCHEMA).count() == 0
    assert files.read_csv(spark, path, SCHEMA, ordinal="o").count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_random_cells_under_any_splits(spark, seed):
    rng = random.Random(seed)
    parts = ['"', ",", "\n", "\r", "\r\n", " ", "a", "b", "é", ""]
    cell = lambda n: "".join(rng.choice(parts) for _ in range(rng.randrange(n)))
    rows = [(str(i), cell(9), cell(4)) for i in range(700)]
    path = write(rows, end=rng.choice(["\n", "\r\n"]))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in ("400", "3000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            got = files.read_csv(spark, path, SCHEMA, ordinal="place").collect()
            assert Counter(tuple(r)[:3] for r in got) == expected(rows)
            assert [r["id"] for r in sorted(got, key=lambda r: r["place"])] == [r[0] for r in rows]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
