"""Feature collections cut by bytes: the same features whatever the cuts."""

import json
import random

import pytest

from arealis.sources import features, geojson

PROPERTIES = "name string, n int"


def feature(k, draw):
    name = "".join(draw.choice(["a", "{", "}", '"', "\\", "é", "🙂", "\n", "[", ",", ":", '{"type":"Feature"', "}}"]) for _ in range(draw.randrange(12)))
    geometry = {"type": "Polygon", "coordinates": [[[draw.random(), draw.random()] for _ in range(draw.randrange(4, 30))]]}
    return {"type": "Feature", "id": k, "properties": {"name": name, "n": k, "more": {"deep": [{}, {"x": "}"}]}}, "geometry": geometry}


def collection(path, n, seed, indent=None, ascii_=True, members=True):
    draw = random.Random(seed)
    found = [feature(k, draw) for k in range(n)]
    whole = {"type": "FeatureCollection"}
    if members:
        whole |= {"crs": {"type": "name", "properties": {"name": 'urn:"ogc}{'}}, "title": 'a } "quoted" { title\\'}
    whole["features"] = found
    if members:
        whole |= {"links": [{"href": "x}"}], "bbox": [0, 0, 1, 1], "empty": {}}
    path.write_text(json.dumps(whole, indent=indent, ensure_ascii=ascii_), encoding="utf-8")
    return sorted((f["properties"]["n"], f["properties"]["name"], json.dumps(f["geometry"])) for f in found)


def rows(spark, path):
    got = geojson.read_features(spark, str(path), PROPERTIES, geometry=True).collect()
    return sorted((r.n, r.name, json.dumps(json.loads(r.geometry))) for r in got)


@pytest.fixture
def cut(spark):
    """Files are cut into blocks of so many bytes."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}

    def at(size):
        for k in keys:
            spark.conf.set(k, str(size))

    yield at
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("size", [37, 300, 4000, 10**7])
@pytest.mark.parametrize("indent, ascii_", [(None, True), (2, False)])
def test_features_whatever_the_cuts(spark, tmp_path, cut, size, indent, ascii_):
    want = collection(tmp_path / "a.geojson", 6 if size < 100 else 25, 1, indent, ascii_)
    want += collection(tmp_path / "b.geojson", 4, 2, indent, ascii_, members=False)
    cut(size)
    assert rows(spark, tmp_path) == sorted(want)


def test_a_large_file_is_parsed_by_many_tasks(spark, tmp_path, cut):
    want = collection(tmp_path / "a.geojson", 3000, 3)
    cut(100_000)
    texts = features.feature_texts(spark, str(tmp_path / "a.geojson"))
    found = features.records(spark, str(tmp_path / "a.geojson"))
    begin = features.beginnings(features.summaries(found))
    objects = features.objects(found, begin).groupBy("start").count().collect()
    assert len(begin) > 10 and sum(r["count"] > 50 for r in objects) > 10
    assert texts.count() == 3000 + 3 and rows(spark, tmp_path) == want


def test_one_feature_over_many_blocks(spark, tmp_path, cut):
    long = {"type": "Feature", "properties": {"name": "}{" * 3000, "n": 1}, "geometry": {"type": "Point", "coordinates": [1.5, 2]}}
    (tmp_path / "a.json").write_text(json.dumps({"type": "FeatureCollection", "features": [long, dict(long, properties={"name": '"', "n": 2})]}))
    cut(64)
    assert [(n, name) for n, name, _ in rows(spark, tmp_path)] == [(1, "}{" * 3000), (2, '"')]


@pytest.mark.parametrize("text", ["", "{}", '{"type":"FeatureCollection","features":[]}', '{"features": [null, 3, "x}"]}', "[1, 2]"])
def test_collections_without_features(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    assert rows(spark, tmp_path) == []


def test_steps():
    assert features.steps('{"a": "{", "b": {', False) == ([0, 16], False)
    assert features.steps('{"a": "x', False) == ([0], True)
    assert features.steps('y", "c": {', True) == ([9], False)
    assert features.steps("no quote {", True) == ([], True)
    assert features.steps('\\" still', True) == ([], True)
