"""Catalogues, listings, reports and stages through files."""

import gzip
import json

import pytest

from orthoweave.sources import catalog_csv, external, files

HEAD = [names[-1] for names in catalog_csv.HEADERS.values()]


def _row(eid, nw="26.0", yes="Y"):
    return [eid, "1968/01/02", "1104", "24", "Aft", yes, "25.5", "50.5", nw, "50.0", "26.0", "51.0", "25.0", "51.0", "25.0", "50.0"]


def test_catalogue(spark, tmp_path):
    path = tmp_path / "corona2_x.csv"
    path.write_bytes("\n".join(",".join(r) for r in [HEAD, _row("DS1104-1057DA024"), _row(""), _row("DS1104-1057DA025", nw="n/a"), _row("DS1104-1057DF026", yes="N")]).encode("latin-1"))
    got = catalog_csv.read_catalog(spark, [str(path)]).sort("entity_id").collect()
    assert [(r.entity_id, r.available, r.camera, r.designation, r.dataset, r.west, r.north) for r in got] == [("DS1104-1057DA024", True, "KH-4", "A", "corona2", 50.0, 26.0), ("DS1104-1057DF026", False, "KH-4", "F", "corona2", 50.0, 26.0)]
    assert str(got[0].acquisition_date) == "1968-01-02"
    with pytest.raises(KeyError, match="entity_id"):
        catalog_csv.resolve(["Mission"])


def test_listings(spark, tmp_path):
    for name in ("DS1_b.tif", "DS1_a.tif", "DS2_a.tif", "other.tif"):
        (tmp_path / name).write_bytes(b"x")
    got = {r.entity_id: [p.rsplit("/", 1)[1] for p in r.frames] for r in files.frames(spark, str(tmp_path)).collect()}
    assert got == {"DS1": ["DS1_a.tif", "DS1_b.tif"], "DS2": ["DS2_a.tif"]}
    (tmp_path / "z").mkdir()
    (tmp_path / "z/a.gz").write_bytes(gzip.compress(b"x"))
    (tmp_path / "z/b").write_bytes(b"x")
    assert {r.path[-1]: r.gzip for r in files.gzipped(spark, str(tmp_path / "z")).collect()} == {"z": True, "b": False}


def test_anchors_of_both_forms(spark, tmp_path):
    own = {"gcps": [{"name": "a", "lon": 1.0, "lat": 2.0, "confidence": 0.5}]}
    geo = {"features": [{"properties": {"name": "a", "confidence": 0.5}, "geometry": {"coordinates": [1.0, 2.0]}}]}
    rows = []
    for k, doc in enumerate((own, geo)):
        (tmp_path / f"{k}.json").write_text(json.dumps(doc))
        rows.append(files.anchors(spark, str(tmp_path / f"{k}.json")).collect())
    assert rows[0] == rows[1] and rows[0][0].lat == 2.0


def test_reports_and_stages(spark, tmp_path):
    for v in (1, 2):
        (tmp_path / f"run_v{v}").mkdir()
        (tmp_path / f"run_v{v}/qa.json").write_text(json.dumps({"selected_candidate": "affine", "reports": [{"candidate": "affine", "accepted": True, "total_score": 10.0 * v, "confidence": 0.5}]}))
    got = files.run_reports(spark, str(tmp_path))
    assert sorted((r.version, r.total_score) for r in got.collect()) == [(1, 10.0), (2, 20.0)]
    files.save_stage(got, str(tmp_path / "s"), "qa")
    assert sorted(files.load_stage(spark, str(tmp_path / "s"), "qa").collect()) == sorted(got.collect())
    files.write_reports(got, str(tmp_path / "json"), by="version")
    assert spark.read.json(str(tmp_path / "json")).count() == 2


def test_external_boundary(spark):
    rows = spark.createDataFrame([(1, [0.5])], "tile long, px array<double>")
    assert external.run("warped_tiles", rows).first().px == [0.5]
    with pytest.raises(ValueError, match="unknown kind"):
        external.register("nothing", lambda it: it)
