"""Configuration and the inventory of files."""

import json

import pytest

from annalist.config import Config
from annalist.sources.inventory import CategoryRule, ExcludeRule, duplicates, inventory, standard_names


def test_config_layers(tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"paths": {"root": "/file"}, "dataset": {"year_range": [2018, 2022]}}))
    c = Config.load(tmp_path / "c.json", environ={"ANNALIST_PATHS__ROOT": "/env"}, clean={"null_threshold": 0.5})
    assert c.path("raw") == "/env/raw" and c.dataset() == "/env/merged/2018-2022.parquet" and c.values["clean"] == {"drop_duplicates": True, "null_threshold": 0.5}
    c.save(tmp_path / "d.json")
    assert Config.load(tmp_path / "d.json", environ={}).values == c.values
    with pytest.raises(ValueError):
        c.updated(dataset={"name": "x.csv"})
    with pytest.raises(ValueError):
        c.updated(paths={"a": {"base": "b", "path": "x"}, "b": {"base": "a", "path": "y"}}).path("a")
    with pytest.raises(KeyError):
        c.path("nowhere")


def test_inventory(spark):
    files = spark.createDataFrame(
        [("Census 2018_19.xlsx", "Y11 201819 Census"), ("Census 2018_19.xlsx", "notes"), ("KS2 2018_19.xlsx", "any"), ("ANON old census 2018_19.xlsx", "Y11 201819 Census"), ("what.csv", None)],
        "file_name string, sheet_name string",
    )
    got = inventory(files, [CategoryRule("census", ["census"], ["2018"]), CategoryRule("ks2", ["ks2"])], [ExcludeRule("census", ["notes"])])
    rows = {(r["file_name"], r["sheet_name"]): r for r in got.collect()}
    first = rows["Census 2018_19.xlsx", "Y11 201819 Census"]
    assert (first["category"], first["cohort"], first["year_group"], first["label"], first["needs_review"]) == ("census", "2018 - 2019", 11, "Y11 2018 - 2019", False)
    assert rows["Census 2018_19.xlsx", "notes"]["category"] == "EXCLUDE" and not rows["Census 2018_19.xlsx", "notes"]["needs_review"]
    ks2 = rows["KS2 2018_19.xlsx", "any"]
    assert (ks2["year_group"], ks2["label"]) == (6, "Y6 2013 - 2014")
    assert rows["what.csv", None]["category"] is None and rows["what.csv", None]["needs_review"]
    assert duplicates(got).count() == 2
    assert {r["standard_name"] for r in standard_names(got).where("category = 'ks2'").collect()} == {"ks2_2018-2019_2013-2014_Y6.parquet"}
