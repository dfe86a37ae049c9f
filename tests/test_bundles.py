import hashlib

import pytest

from millrace.sources import bundles

CONTRACT = {"teams": ("id INT, name STRING", ["id"]), "games": ("a INT, b INT, at TIMESTAMP_NTZ", ["a", "b"])}


def tables(spark, names=("x", "y")):
    return {"teams": (spark.createDataFrame([(i, n) for i, n in enumerate(names)], CONTRACT["teams"][0]), ["id"]), "games": (spark.createDataFrame([(0, 1, None), (1, 0, None)], CONTRACT["games"][0]), ["a", "b"])}


def test_reference_is_taken_over_whole_and_once(spark, tmp_path):
    root = str(tmp_path / "ref")
    with pytest.raises(ValueError, match="no reference"):
        bundles.current(spark, root, "teams")
    for i, names in enumerate((("x", "y"), ("x", "z"))):
        bundles.write_bundle(tables(spark, names), str(tmp_path / f"b{i}"))
        assert bundles.take_over(spark, str(tmp_path / f"b{i}"), root, CONTRACT) == i
        assert bundles.take_over(spark, str(tmp_path / f"b{i}"), root, CONTRACT) is None
        assert [r.name for r in bundles.current(spark, root, "teams").orderBy("id").collect()] == list(names)


def test_faults_are_named(spark, tmp_path):
    good = tables(spark)
    bundles.write_bundle(good, str(tmp_path / "b"))
    spark.createDataFrame([(7, "other")], CONTRACT["teams"][0]).write.mode("overwrite").parquet(str(tmp_path / "b" / "teams"))
    with pytest.raises(ValueError, match="^teams: content$"):
        bundles.read_bundle(spark, str(tmp_path / "b"), CONTRACT)
    twice = good["teams"][0].union(good["teams"][0])
    bundles.write_bundle({"teams": (twice, ["id"]), "more": good["games"]}, str(tmp_path / "c"))
    with pytest.raises(ValueError, match="games: not in the bundle; more: not in the contract; teams: key"):
        bundles.read_bundle(spark, str(tmp_path / "c"), CONTRACT)
    with pytest.raises(ValueError, match="teams: schema"):
        bundles.read_bundle(spark, str(tmp_path / "c"), {"teams": ("id LONG, name STRING", ["id"]), "more": CONTRACT["games"]})


def test_graph_release(spark, tmp_path):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    nodes = spark.createDataFrame([("b", "k", "y", sha("y"), None), ("a", "k", "x", sha("x"), "{}")], "node_id string, kind string, content string, content_sha256 string, properties_json string")
    edges = spark.createDataFrame([("e", "a", "b", "z", sha("z"))], "edge_id string, source_id string, target_id string, content string, content_sha256 string")
    manifest = bundles.release_graph(nodes, edges, str(tmp_path / "g"))
    assert (manifest["nodes"]["rows"], manifest["edges"]["rows"]) == (2, 1) and (tmp_path / "g" / "manifest").exists()
    with pytest.raises(ValueError, match="dangling_edge: 1, lone_node: 1"):
        bundles.release_graph(nodes.where("node_id = 'a'").union(nodes.where("node_id = 'b'").replace("b", "c", "node_id")), edges, str(tmp_path / "h"))
    assert not (tmp_path / "h").exists()
