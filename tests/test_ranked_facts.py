"""Row ids of the sampling jobs are ranks by the reviews' keys: a table whose
rows lie in another order, some of unknown products, against ranks counted
here."""

import datetime
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from revlens.plans.catalog import load_all

NAMES = ["m1_per_class_sample", "m2_capped_sample", "m3_stratified_union", "m4_three_way_split",
         "m8_oversample", "a16_first_seen_order", "u1_union_by_class"]
N, PARTS = 40_000, 50


@pytest.fixture(scope="module")
def tables(tmp_path_factory):
    """(folder, {rank: (label, category, store)})"""
    base = tmp_path_factory.mktemp("ranked")
    rnd = random.Random(3)
    part = [(k, f"type {k % 5}", f"Brand#{k % 7}", f"part {k}", 10.0 + k) for k in range(PARTS)]
    names = ["p_partkey", "p_type", "p_brand", "p_name", "p_retailprice"]
    pq.write_table(pa.table(dict(zip(names, map(list, zip(*part))))), base / "part.parquet")
    # a tenth of the rows have products that `part` lacks
    rows = [(k // 5, 1 + k % 5, 7 * k % 11, rnd.randrange(PARTS * 10 // 9), float(rnd.randrange(1, 51)),
             rnd.choice("RNA"), datetime.datetime(2020, 1, 1) + datetime.timedelta(hours=k)) for k in range(N)]
    known = [r for r in rows if r[3] < PARTS]
    of = {}
    for rank, (_, line, _, product, quantity, flag, _) in enumerate(known):
        points = (line >= 4) - (line <= 2) + 0.5 * (flag == "R") + 0.5 * (int(quantity) % 10 >= 5)
        of[rank] = (0 if points > 1 else 1 if points < 0 else 2, part[product][1], part[product][2])
    rnd.shuffle(rows)
    names = ["l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_quantity", "l_returnflag", "l_shipdate"]
    pq.write_table(pa.table(dict(zip(names, map(list, zip(*rows))))), base / "lineitem.parquet")
    return str(base), of


@pytest.mark.parametrize("name", NAMES)
def test_row_ids_are_ranks(spark, tables, name):
    folder, of = tables
    query = load_all()[name]
    got = query.build(spark, folder)
    names = sorted(got.columns)
    rows = [tuple(r[c] for c in names) for r in got.collect()]
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = con.execute(f"SELECT {', '.join(names)} FROM ({query.sql})").fetchall()
    assert sorted(map(repr, rows)) == sorted(map(repr, want)) and rows
    fields = {"label": 0, "main_category": 1, "store": 2}
    key = "first_row_id" if "first_row_id" in names else "row_id"
    for r in rows:
        x = dict(zip(names, r))
        assert all(x[c] == of[x[key]][k] for c, k in fields.items() if c in x)
