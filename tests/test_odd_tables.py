"""Queries against their SQL over tables whose rows are odd or dealt to several files."""

import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq

from ampliscope.plans import registry


def lineitem(path, rows, files=2):
    """rows: (partkey, suppkey, linenumber, quantity, discount, tax, returnflag)."""
    names = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.string()]
    columns = {n: pa.array(c, t) for n, t, c in zip(names, kinds, zip(*rows, strict=True), strict=True)}
    columns |= {"l_orderkey": pa.array(range(len(rows)), pa.int64()), "l_extendedprice": pa.array([1.0] * len(rows))}
    all_rows, at = pa.table(columns), path / "lineitem.parquet"
    at.mkdir()
    for i in range(files):
        part = all_rows.slice(len(rows) * i // files, len(rows) * (i + 1) // files - len(rows) * i // files)
        pq.write_table(part, at / f"part-{i}.parquet")


def against_sql(spark, path, name):
    con = duckdb.connect()
    con.execute("set threads = 1")
    con.execute(f"create view lineitem as select * from '{path}/lineitem.parquet/*.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    got = registry.queries()[name](spark, str(path)).select(*names).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(found.fetchall(), key=repr)


def test_library_type_at_a_limit_in_several_files(spark, tmp_path):
    rows = []
    for supplier in range(8):
        cents = [1, 9, 0, 10, 4, 6, 5, 5, 2, 8, 3, 7] * 300  # a mean of 0.05, but for rounding
        random.Random(supplier).shuffle(cents)
        rows.append([(k % 1000, supplier, 1, 1.0, x / 100, 0.04, "A") for k, x in enumerate(cents)])
    # each supplier's rows lie in both files
    rows = [r for half in (0, 1) for own in rows for r in own[1800 * half : 1800 * half + 1800]]
    none = [(1, None, 1, 1.0, 0.05, 0.04, "A")] * 75
    rows = [*none, *rows, *none]
    lineitem(tmp_path, rows)
    against_sql(spark, tmp_path, "library_type")


def test_alignment_penalty_of_odd_lines(spark, tmp_path):
    rng = random.Random(1)
    one = lambda: (rng.choice([None, 0, 7, 10**12]), 1, rng.choice([None, 0, 1, 2, 30]), rng.choice([None, 1.0, 2.5, 3.5, 20.7, 5.0]), 0.0, 0.0, rng.choice([None, "A", "N", "R", "X", ""]))
    lineitem(tmp_path, [one() for _ in range(3000)])
    against_sql(spark, tmp_path, "alignment_penalty")
