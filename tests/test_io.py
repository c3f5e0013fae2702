import pytest

from conftest import matrix
from cellscape.sources import matrix_io as IO


def test_csv_orientation_rule(spark, tmp_path):
    # m12: a 5 x 3 file keeps rows as cells only when columns >= rows; here 3 < 5 -> transposed
    p = tmp_path / "m.csv"
    p.write_text(",g0,g1,g2\nc0,1,0,2\nc1,0,3,0\nc2,4,0,0\nc3,0,0,1\nc4,1,1,1\n")
    m = IO.load_counts(spark, str(p))
    assert m.cells.count() == 3 and m.genes.count() == 5
    names = {r.cell_name for r in m.cells.collect()}
    assert names == {"g0", "g1", "g2"}
    p2 = tmp_path / "w.csv"
    p2.write_text(",g0,g1,g2,g3,g4\nc0,1,0,2,0,0\nc1,0,3,0,0,1\nc2,4,0,0,2,0\n")
    m2 = IO.load_counts(spark, str(p2))
    assert m2.cells.count() == 3 and m2.expr.count() == 6


def test_mtx_roundtrip_and_unique_symbols(spark, tmp_path):
    m = matrix(spark, [(0, 0, 1), (0, 2, 5), (1, 1, 2), (2, 2, 7)], 3, 3, names=["X", "X", "Y"])
    m = m.with_cells(m.cells.selectExpr("cell_id", "concat('bc', cell_id) AS cell_name"))
    folder = IO.write_counts_mtx(m, str(tmp_path / "mtx"))
    back = IO.read_counts_mtx(spark, folder + "/matrix.mtx")
    assert sorted(r.gene_name for r in back.genes.collect()) == ["X", "X-1", "Y"]
    got = sorted((r.cell_id, r.gene_id, r.value) for r in back.expr.collect())
    assert got == [(1, 1, 1.0), (1, 3, 5.0), (2, 2, 2.0), (3, 3, 7.0)]


def triples(m):
    named = m.expr.join(m.cells.select("cell_id", "cell_name"), "cell_id").join(m.genes.select("gene_id", "gene_name"), "gene_id")
    return sorted((r.cell_name, r.gene_name, r.value) for r in named.collect())


def test_round_trips_over_many_part_files_and_blocks(spark, tmp_path):
    values = [(c, g, (c * 7 + g) % 5) for c in range(40) for g in range(60)]
    m = matrix(spark, values, 40, 60, names=[f"gene{g}" for g in range(60)])
    m = m.with_cells(m.cells.selectExpr("cell_id", "concat('cell', cell_id) AS cell_name"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.files.maxPartitionBytes")}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")  # several blocks in a file, several files in a folder
    try:
        csv = IO.write_counts_csv(m, str(tmp_path / "m.csv"))
        assert len(list((tmp_path / "m.csv" / "rows").glob("part-*"))) > 2
        back = IO.load_counts(spark, csv)
        assert [r.cell_name for r in back.cells.orderBy("cell_id").collect()] == [f"cell{c}" for c in range(40)]
        assert triples(back) == triples(m)
        mtx = IO.write_counts_mtx(m, str(tmp_path / "mtx"))
        assert len(list((tmp_path / "mtx" / "features.tsv").glob("part-*"))) > 2
        back = IO.read_counts_mtx(spark, mtx)
        assert [r.cell_name for r in back.cells.orderBy("cell_id").collect()] == [f"cell{c}" for c in range(40)]
        assert triples(back) == triples(m)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_files_in_order_of_name_not_of_size(spark, tmp_path):
    folder = tmp_path / "m.csv"
    folder.mkdir()
    (folder / "part-00000").write_text(",a,b,c,d\nx,1,0,0,0\n")
    (folder / "part-00001").write_text("".join(f"y{i},0,2,0,0.5\n" for i in range(300)))
    (folder / "part-00002").write_text("z,0,0,3,\n")
    m = IO.read_counts_csv(spark, str(folder))
    assert [r.cell_name for r in m.cells.orderBy("cell_id").collect()] == ["x", *(f"y{i}" for i in range(300)), "z"]
    assert m.expr.where("cell_id = 301").collect()[0].value == 3.0


def test_a_plain_copy_is_read_once_and_bad_numbers_are_errors(spark, tmp_path):
    import gzip

    for name, text in (("features.tsv", "i1\tA\tGene Expression\ni2\tB\tOther\n"), ("barcodes.tsv", "b1\nb2\n"),
                       ("matrix.mtx", "%%MatrixMarket matrix coordinate real general\n% note\n2 2 2\n1 1 4\n2 2 5\n")):
        (tmp_path / name).write_text(text)
        (tmp_path / f"{name}.gz").write_bytes(gzip.compress(text.encode()))
    m = IO.load_counts(spark, str(tmp_path / "matrix.mtx"))
    assert (m.cells.count(), m.genes.count(), [tuple(r) for r in m.expr.collect()]) == (2, 1, [(1, 1, 4.0)])
    (tmp_path / "bad.csv").write_text(",a,b,c\nx,1,oops,\n")
    with pytest.raises(Exception, match="oops"):
        IO.read_counts_csv(spark, str(tmp_path / "bad.csv")).expr.collect()
    with pytest.raises(ValueError, match="no matrix reader"):
        IO.load_counts(spark, "counts.h5ad")


def test_wide_csv_lines_are_made_and_read_a_few_at_a_time(spark, tmp_path, monkeypatch):
    m = matrix(spark, [(c, (c * 37) % 500, c + 0.5) for c in range(60)], 60, 500, names=[str(g) for g in range(500)])
    m = m.with_cells(m.cells.selectExpr("cell_id", "concat('cell', cell_id) AS cell_name"))
    monkeypatch.setattr(IO, "_TEXT_BYTES", 5000)
    path = IO.write_counts_csv(m, str(tmp_path / "m.csv"), codec="lz4")
    back = IO.read_counts_csv(spark, path)
    assert triples(back) == triples(m) and back.cells.count() == 60 and back.genes.count() == 500
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"
    text = "\n".join(["   ", ",1, b ,0.0,d", "", "x ,0,0.0,0.00,", " y,-0.0, 7,,1e2,9"])
    (tmp_path / "w.csv").write_text(text)
    back = IO.read_counts_csv(spark, str(tmp_path / "w.csv"))
    assert [(r.gene_id, r.gene_name) for r in back.genes.orderBy("gene_id").collect()] == [(0, "1"), (1, "b"), (2, "0.0"), (3, "d")]
    assert [(r.cell_id, r.cell_name) for r in back.cells.orderBy("cell_id").collect()] == [(1, "x"), (2, "y")]
    assert sorted((r.cell_id, r.gene_id, r.value) for r in back.expr.collect()) == [(2, 1, 7.0), (2, 3, 100.0), (2, 4, 9.0)]
    parse = IO._filled_fields(",")
    batch = IO.pa.RecordBatch.from_pydict({"line": ["c,0.0,2,0,", "c"], "file": ["f", "f"], "start": [0, 0], "at": [0, 1]})
    assert next(parse(iter([batch]))).to_pydict()["places"] == [[1], []]
