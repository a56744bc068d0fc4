"""Every registered query of the reference's operators against DuckDB."""

import itertools

import pytest
from conftest import SF, same

from foliomill.functions.text import LATER
from foliomill.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_matches_sql(name, spark, duck):
    same(registry.QUERIES[name](spark, SF), duck, registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(name, spark):
    assert registry.QUERIES[name](spark, SF).columns


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).columns
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_defaulted_arrays_have_all_conversations(spark, tmp_path):
    spark.createDataFrame([(1, 0), (1199, 0), (1200, 1), (1200, 0), (90_000, 3), (None, 1)], "conv_id long, turn long").write.parquet(f"{tmp_path}/conversations.parquet")
    spark.range(1200).withColumnRenamed("id", "doc_id").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.conv_id: r.turns for r in registry.QUERIES["defaulted_arrays"](spark, str(tmp_path)).collect()}
    assert len(found) == 1202
    assert {k: t for k, t in found.items() if t} == {1: "0", 1199: "0", 1200: "0,1", 90_000: "3"}


def test_as_many_pages_as_documents(spark):
    assert registry.QUERIES["planned_pages"](spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()


def test_paragraph_duplicates_of_any_characters(spark, tmp_path):
    """Lines with each of many characters inside, and twice, in other case and with other spaces around, at the ends."""
    import duckdb
    import pyarrow as pa
    import pyarrow.parquet as pq

    later = [range(int(r.split("-")[0], 16), int(r.split("-")[-1], 16) + 1) for r in LATER.split()]
    letters = [chr(c) for c in sorted({*range(1, 0x2100), *range(0x2C00, 0x3100), *range(0xA700, 0xA800), *itertools.chain(*(r[:99] for r in later))} - {10})]
    words = "Ein Absatz von mehr als achtzig Zeichen, damit er als Absatz gilt und gezählt wird: "
    texts = [f"{words}a{c}b {ord(c)}\n{words}A{c}B, {ord(c)}" for c in letters]
    spaces = "\t\x0b \u00a0\u1680\u180e\u2003\u2007\u200b\u202f\u205f\u3000\ufeff"
    texts += [f"{a}{words}{b}" for a in spaces for b in spaces] + [f"{words} ΟΔΟΣ\n{words} οδοσ\n{words} οδος\n{words}İ\n{words}i", "\t" * 81 + "\n" + "\u3000" * 81, None, ""] * 2
    pq.write_table(pa.table({"doc_id": range(len(texts)), "text": pa.array(texts, pa.string())}), f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT *, '' AS source, '' AS lang FROM '{tmp_path}/documents.parquet'")
    found = {tuple(r) for r in registry.QUERIES["paragraph_duplicates"](spark, str(tmp_path)).collect()}
    assert found == set(con.execute(registry.ORACLES["paragraph_duplicates"]).fetchall())
