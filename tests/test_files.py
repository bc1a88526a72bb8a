"""Round trips of the file sources and sinks."""

from entres.sources import files


def test_entities(spark, tmp_path):
    path = tmp_path / "s.tsv"
    path.write_text('entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-1\t"a" NULL\t\tfr\nS2-7\tb  c\tx\t\n', encoding="utf-8")
    rows = {r.entity_id: r for r in files.read_entities(spark, str(path)).collect()}
    assert rows["S1-1"].business_name == '"a" NULL' and rows["S1-1"].business_address is None and rows["S1-1"].source == "S1"
    assert rows["S2-7"].business_name == "b  c" and rows["S2-7"].country is None and rows["S2-7"].source == "S2"


def test_results(spark, tmp_path):
    universe = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-2",)], "s1 string")
    pairs = spark.createDataFrame([("S1-1", "S2-9", 0.5), ("S1-1", "S3-1", 0.9), ("S1-1", "S2-3", 0.5), ("S1-1", "S3-1", 0.9)], "s1 string, cand string, p double")
    files.write_results(universe, pairs.where("p > 0.6"), pairs, str(tmp_path))
    got = {r[0]: r[1] for r in files.read_tsv(spark, f"{tmp_path}/candidate_pairs.tsv", files.TRUTH).collect()}
    assert got == {"S1-1": "S3-1,S2-3,S2-9", "S1-2": None}
    truth = {tuple(r) for r in files.read_truth(spark, f"{tmp_path}/matching_results.tsv").collect()}
    assert truth == {("S1-1", "S3-1"), ("S1-2", None)}
