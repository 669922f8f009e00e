"""Documents that are one array, read in many small splits and written by many tasks."""

import json
import random

import pytest

from spokes.sources import census, geojson
from spokes.sources.json_documents import elements, write_document


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}

    def to(n):
        for k in before:
            spark.conf.set(k, str(n))
    yield to
    for k, v in before.items():
        spark.conf.set(k, v)


def got(df):
    rows = sorted((r["file"], r["block"], r["index"], r["text"]) for r in df.collect())
    return [json.loads(r[3]) for r in rows], len({r[1] for r in rows})


@pytest.mark.parametrize("split", [60, 700, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_elements_at_any_split(spark, tmp_path, small_splits, split, indent):
    rng = random.Random(split)
    odd = ['}', '{', '"', '\\', '\\"', ']}', '[[', 'é\U0001f600', '\n', '', 'x' * 60]
    text = lambda: "".join(rng.choice(odd) for _ in range(rng.randint(0, 6)))
    features = [{"a": text(), "nested": {"b": [{"c": text()}, [text()]]}, "n": i} for i in range(15)]
    doc = {"type": text(), "crs": {"p": {"name": "not in the array"}}, "features": features, "after": [text()]}
    (tmp_path / "doc.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=False))
    rows = [[text(), None, str(i)] for i in range(25)] + [[], ["x" * 300]]
    (tmp_path / "rows.json").write_text(json.dumps(rows, indent=indent, ensure_ascii=False))
    small_splits(split)
    found, blocks = got(elements(spark, str(tmp_path / "doc.json"), depth=3, end="}"))
    assert [f for f in found if "n" in f] == features and (split > 1000 or blocks > 1)
    found, blocks = got(elements(spark, str(tmp_path / "rows.json"), end="]"))
    assert found == rows and (split > 1000 or blocks > 1)


def test_census_responses_as_they_may_come(spark, tmp_path, small_splits):
    head = ["NAME", census.POPULATION, census.HOUSEHOLDS, census.MEDIAN_INCOME, "state", "county", "tract"]
    rows = [[f"Tract {i}, [here]", str(i), "5", "-666666666" if i % 2 else "70000", "11", "001", f"{i:06d}"] for i in range(40)]
    forms = {"line": json.dumps([head, *rows]), "indented": json.dumps([head, *rows], indent=2),
             "api": "[" + ",\n".join(json.dumps(r) for r in [head, *rows]) + "]"}
    small_splits(100)
    for name, text in forms.items():
        (tmp_path / f"{name}.json").write_text(text)
        out = census.clean(census.read_census(spark, str(tmp_path / f"{name}.json"))).orderBy("geoid").collect()
        assert [(r.geoid, r.population, r.median_household_income) for r in out] == [
            (f"11001{i:06d}", i, None if i % 2 else 70000.0) for i in range(40)]
    (tmp_path / "empty.json").write_text(json.dumps([head]))
    with pytest.raises(ValueError, match="no data row"):
        census.read_census(spark, str(tmp_path / "empty.json"))
    (tmp_path / "none.json").write_text(json.dumps(rows))
    with pytest.raises(ValueError, match="no header row"):
        census.read_census(spark, str(tmp_path / "none.json"))


def test_feature_collection_written_and_read(spark, tmp_path):
    ring = "array(" + ",".join(f"struct({x}D as x, {y}D as y)" for x, y in ((0, 0), (1, 0), (1, 1), (0, 0))) + ")"
    layer = spark.range(50, numPartitions=7).selectExpr("id", "concat('n\"}', id) AS name", f"array(array({ring})) AS geometry")
    path = str(tmp_path / "layer.geojson")
    for df in (layer, layer.where("id < 3")):  # a second one replaces the first
        geojson.write_feature_collection(df, path, ["id", "name"])
        doc = json.loads((tmp_path / "layer.geojson").read_text())
        assert doc["type"] == "FeatureCollection" and sorted(f["properties"]["id"] for f in doc["features"]) == list(range(df.count()))
    from pyspark.sql.types import _parse_datatype_string

    back = geojson.read_features(spark, path, _parse_datatype_string("id long, name string"))
    assert sorted((r.id, r.name, r.geometry_type, len(r.geometry[0][0])) for r in back.collect()) == [
        (i, f'n"}}{i}', "MultiPolygon", 4) for i in range(3)]
    write_document(layer.limit(0).selectExpr("name AS value"), path, "[", "]")
    assert json.loads((tmp_path / "layer.geojson").read_text()) == []
