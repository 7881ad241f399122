"""Result trees, fixed-width records, logs and CSV tables."""

import os

import pytest
from pyspark.sql import functions as F

from runlens import sources
from runlens.functions import chain_from_name, loose_key, relaxed_sibling, strict_key
from runlens.streaming import follow_outcomes, follow_quality

ATOMS = """ATOM      1  N   MET A   1      11.104   6.134  -6.504  1.00 80.00           N
ATOM      2  CA  MET A   1      11.639   6.071  -5.147  1.00 90.00           C
ATOM      3  CA  GLY A   2      12.639   7.071  -4.147  1.00 70.00           C
ATOM      4  CA  ALA A   3      13.639   8.071  -3.147  1.00  ****           C
ATOM      5  CA  ALA A   4      13.639   8.071  -3.147  1.00   nan           C
ATOM      6  CA  ALA A   5      13.639
HETATM    7 CA    CA A 201      14.639   9.071  -2.147  1.00 10.00          CA
"""
FILES = [
    "epoch_3/your_model_epoch_3/repeat_2/predictions/1abc_A_model_1_unrelaxed.pdb",
    "epoch_3/your_model_epoch_3/repeat_2/predictions/1abc_A_model_1_relaxed.pdb",
    "epoch_3/trained_model_epoch_3/repeat_2/predictions/1abc_B_model_1_unrelaxed.pdb",
    "epoch_3/your_model_epoch_3/repeat_2/predictions/1abc_C_model_2_unrelaxed.pdb",
    "misc/repeat_2/predictions/x_unrelaxed.pdb",
    "epoch_3/your_model_epoch_3/repeat_2/predictions/1abc_A_model_1_unrelaxed_relax1.pdb",
]


@pytest.fixture(scope="module")
def tree(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    for i, f in enumerate(FILES):
        os.makedirs(root / os.path.dirname(f), exist_ok=True)
        (root / f).write_bytes(ATOMS.replace("\n", "\r\n" if i == 1 else "\n").encode())
    return str(root)


def test_listing(spark, tree):
    assert sources.list_files(spark, tree).count() == 4
    assert sources.list_files(spark, tree, "*_{unrelaxed,relaxed}.pdb").count() == 5
    stats = sources.tree_stats(spark, tree).first()
    assert stats["n_files"] == 6 and stats["n_bytes"] > 0


def test_quality_table(spark, tree):
    found = {(r["chain"], r["state"]): r for r in sources.quality_table(spark, tree).collect()}
    assert set(found) == {("1abc_A", "unrelaxed"), ("1abc_A", "relaxed"), ("1abc_B", "unrelaxed")}
    for r in found.values():
        assert (r["epoch"], r["repeat"], r["mean_plddt"], r["min_plddt"], r["max_plddt"], r["num_residues"]) == (3, 2, 80.0, 70.0, 90.0, 2)
    only = sources.quality_table(spark, tree, models="your_model_epoch_", unrelaxed_only=True).collect()
    assert [(r["chain"], r["state"]) for r in only] == [("1abc_A", "unrelaxed")]
    skipped = sources.skipped_files(spark, tree).collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in skipped) == ["1abc_C_model_2_unrelaxed.pdb", "x_unrelaxed.pdb"]


def test_outcomes_from_files(spark, tree):
    un, re = sources.list_files(spark, tree), sources.list_files(spark, tree, "*_relaxed.pdb")
    found = {r["chain"]: r for r in sources.outcome_listing(un, re).collect()}
    assert {c: r["status"] for c, r in found.items()} == {"1abc_A": "success", "1abc_B": "error", "1abc_C_model_2": "error"}
    assert all((r["epoch"], r["repeat"]) == (3, 2) for r in found.values())
    assert found["1abc_A"]["relaxed_exists"] and found["1abc_A"]["relax_error"] == 0


def test_paths(spark):
    df = spark.createDataFrame([("a/epoch_12/repeat_3/x_model_1_unrelaxed.pdb",), ("a/repeat_1/y",), ("epoch_9/your_model_epoch_9/repeat_1/predictions/c_model_1_RELAXED.pdb",)], "p string")
    found, key = loose_key(F.col("p"))
    rows = df.select(found.alias("ok"), key["epoch"].alias("e"), key["repeat"].alias("r"), chain_from_name(F.col("p")).alias("c"), strict_key(F.col("p"))[0].alias("s"), relaxed_sibling(F.col("p")).alias("z")).collect()
    assert rows[0][:5] == (True, 12, 3, "a/epoch_12/repeat_3/x", False) and rows[0]["z"].endswith("x_model_1_relaxed.pdb")
    assert rows[1]["ok"] is False and rows[1]["e"] is None
    assert rows[2]["s"] is False


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("chain,epoch,v\nNA,1,nan\n1e10,x,2.5\n")
    rows = sources.read_csv_by_name(spark, str(tmp_path / "a.csv"), {"v": "double", "epoch": "int"}).collect()
    assert [tuple(r) for r in rows] == [("NA", 1, None), ("1e10", None, 2.5)]
    empty = spark.createDataFrame([], "a int, b string")
    sources.write_csv(empty, str(tmp_path / "e"), one_file=True)
    assert sources.read_csv_by_name(spark, str(tmp_path / "e")).columns == ["a", "b"] or sources.read_csv_by_name(spark, str(tmp_path / "e")).count() == 0
    sources.write_text("line one\nline two", str(tmp_path / "t"), empty)
    assert [r[0] for r in spark.read.text(str(tmp_path / "t")).collect()] == ["line one", "line two"]


def test_copy_and_preview(spark, tmp_path):
    (tmp_path / "a.csv").write_text("chain,rate,note\nNA,0.10,\"a, b\"\n1e10,nan,x\n")
    assert sources.copy_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "b"))
    assert not sources.copy_csv(spark, str(tmp_path / "none.csv"), str(tmp_path / "c")) and not os.path.exists(tmp_path / "c")
    copied = sources.read_csv_by_name(spark, str(tmp_path / "b"))
    assert [tuple(r) for r in copied.collect()] == [("NA", "0.10", "a, b"), ("1e10", "nan", "x")]
    n, head = sources.preview(copied, 1)
    assert n == 2 and len(head) == 1


def test_scatter(spark):
    from runlens.operators import quality

    df = spark.createDataFrame([(80.0, 1), (None, 0), (70.0, 0)], "mean_plddt double, relax_error int")
    rows, again = (quality.scatter_inputs(df).collect() for _ in range(2))
    assert rows == again and sorted((r[0], r[1]) for r in rows) == [(70.0, 0), (80.0, 1)] and all(abs(r[2] - r[1]) < 0.3 for r in rows)


def test_matrix(spark, tmp_path):
    cells = spark.createDataFrame([("A", 1, 5), ("B", 2, 3)], "chain string, epoch int, success int")
    from runlens.operators import selection

    sources.write_matrix(selection.pivot(cells, "success", [1, 2]), str(tmp_path / "m"))
    found = sources.read_csv_by_name(spark, str(tmp_path / "m"), {"1": "int", "2": "int"})
    assert found.columns == ["chain", "1", "2"] and sorted(tuple(r) for r in found.collect()) == [("A", 5, None), ("B", None, 3)]
    assert len([f for f in os.listdir(tmp_path / "m") if f.endswith(".csv")]) == 1


def test_log_lines(spark, tmp_path):
    (tmp_path / "x.log").write_bytes(b"a\r\nb\n\tc \xff\n")
    rows = sources.read_log_lines(spark, str(tmp_path / "x.log")).orderBy("pos").collect()
    assert [r["line"][:2] for r in rows][:2] == ["a", "b"] and rows[2]["line"].startswith("\tc")


def test_streams(spark, tree, tmp_path):
    q = follow_quality(spark, tree).writeStream.format("memory").queryName("quality_stream").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    rows = spark.table("quality_stream").collect()
    assert {(r["chain"], r["state"], r["mean_plddt"]) for r in rows} == {("1abc_A", "unrelaxed", 80.0), ("1abc_A", "relaxed", 80.0), ("1abc_B", "unrelaxed", 80.0)}
    q = follow_outcomes(spark, tree).writeStream.format("memory").queryName("outcome_stream").outputMode("complete").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    found = {r["chain"]: (r["unrelaxed"], r["relaxed"]) for r in spark.table("outcome_stream").collect()}
    assert found["1abc_A"] == (True, True) and found["1abc_B"] == (True, False)


def test_closed_runs_leave_the_state(spark, tree, tmp_path):
    """With an expiry the runs are sessions: old ones are written once, in append mode."""
    root = tmp_path / "tree"
    for day, chain in ((0, "A"), (40, "B")):
        for state in ("unrelaxed", "relaxed")[: 2 - (chain == "B")]:
            f = root / f"epoch_1/your_model_epoch_1/repeat_1/predictions/{chain}_model_1_{state}.pdb"
            os.makedirs(f.parent, exist_ok=True)
            f.write_text("x")
            os.utime(f, (1_700_000_000 + day * 86_400,) * 2)
    for _ in range(2):  # the second run sees nothing new and only closes what the first left behind the watermark
        q = follow_outcomes(spark, str(root), within="7 days").writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append")
        q.option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start().awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["chain"], r["unrelaxed"], r["relaxed"]) for r in rows] == [("A", True, True)]
