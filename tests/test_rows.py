"""Records of configured datasets, format by format."""

import io
import json
import zipfile

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from sievework.plans import config, curate
from sievework.plans.rows import records
from tests.test_sources import picture


def dataset(**keys):
    cfg = config.read({"datasets": [{"name": "d", **keys}]})
    return cfg.datasets[0]


def names(df):
    return sorted((r["inside"], r["label"], r["generator"]) for r in df.collect())


def test_parquet_by_columns(spark, tmp_path):
    png = picture("noise", 300)
    pq.write_table(pa.table({"picture": [png, png, png], "class": ["real", "AI", "photo"], "model_name": ["camera", "sd15", None], "keep": [1, 1, 0]}), tmp_path / "train-0.parquet")
    pq.write_table(pa.table({"picture": [png], "class": ["real"], "model_name": ["x"], "keep": [1]}), tmp_path / "test-0.parquet")
    d = dataset(path=str(tmp_path), format="parquet", label="auto", source_split="train", label_map={"Photo": "fake"})
    assert names(records(spark, d, d.path)) == [("fake/sd15/d_00000_000000001.png", "fake", "sd15"), ("fake/unknown/d_00000_000000002.png", "fake", "unknown"), ("real/camera/d_00000_000000000.png", "real", "camera")]
    d = dataset(path=str(tmp_path), format="parquet", label="auto", row_filter={"keep": 1}, row_exclude={"model_name": ["SD15"]}, source_split="train")
    assert [x[2] for x in names(records(spark, d, d.path))] == ["camera"]
    d = dataset(path=str(tmp_path), format="parquet", label="real", generator="none", columns={"image": "gone"})
    with pytest.raises(ValueError):
        records(spark, d, d.path)


def test_several_images_of_a_row(spark, tmp_path):
    png = picture("noise", 300)
    pq.write_table(pa.table({"a": [png, None], "b": [png, png], "m": ["m1", None]}), tmp_path / "x.parquet")
    d = dataset(path=str(tmp_path), format="parquet", label="fake", images=[{"column": "a", "generator": "g"}, {"column": "b", "generator_column": "m"}])
    assert [(x[0].split("_", 1)[1], x[2]) for x in names(records(spark, d, d.path))] == [("00000_000000000_i0.png", "g"), ("00000_000000000_i1.png", "m1"), ("00000_000000001_i1.png", "unknown")]


def test_arrow_and_lines(spark, tmp_path):
    (tmp_path / "a").mkdir()
    t = pa.table({"image": [picture("noise", 300)]})
    with pa.OSFile(str(tmp_path / "a" / "x.arrow"), "wb") as f, pa.ipc.new_stream(f, t.schema) as w:
        w.write_table(t)
    d = dataset(path=str(tmp_path / "a"), format="arrow", label="real", generator="g")
    assert names(records(spark, d, d.path)) == [("real/g/d_00000_000000000.png", "real", "g")]
    (tmp_path / "j").mkdir()
    (tmp_path / "j" / "p.png").write_bytes(picture("noise", 300))
    (tmp_path / "j" / "x.jsonl").write_text(json.dumps({"file": "p.png", "kind": "ai"}) + "\n" + json.dumps({"file": "none.png", "kind": "ai"}) + "\n")
    d = dataset(path=str(tmp_path / "j"), format="jsonl", label="column:kind", columns={"image": "file"})
    assert [(x[1], x[2]) for x in names(records(spark, d, d.path))] == [("fake", "d")]


def test_zip_in_parts(spark, tmp_path):
    body = io.BytesIO()
    with zipfile.ZipFile(body, "w") as z:
        for n in ("inputs/a.png", "outputs/fake.png"):
            z.writestr(n, picture("noise", 300))
    raw = body.getvalue()
    for i in range(2):
        (tmp_path / f"all.part_{i}").write_bytes(raw[i * len(raw) // 2 : (i + 1) * len(raw) // 2])
    (tmp_path / "m.jsonl").write_text(json.dumps({"input_images": ["inputs/a.png"], "output_image": "./outputs/fake.png"}) + "\n")
    d = dataset(path=str(tmp_path), format="multipart_zip", multipart_glob="all.part_*", metadata_file="m.jsonl", output_column="output_image", label="fake")
    assert [x[0].split("/", 1)[1] for x in names(records(spark, d, d.path))] == ["outputs/fake.png"]
    (tmp_path / "m.jsonl").write_text(json.dumps({"output_image": ["outputs/none.png"]}) + "\n")
    with pytest.raises(ValueError):
        records(spark, d, d.path)


def test_flow_through_shards(spark, tmp_path):
    kinds = ("gradient", "flat", "circle", "noise", "circle")
    (tmp_path / "src").mkdir()
    pq.write_table(pa.table({"image": [picture(k, 300 + 20 * i) for i, k in enumerate(kinds)], "label": ["real", "real", "real", "fake", "real"]}), tmp_path / "src" / "x.parquet")
    cfg = config.read({
        "runtime": {"work_dir": f"{tmp_path}/work", "data_dir": f"{tmp_path}/data"}, "filters": {"laplacian_min": 0.0001, "laplacian_max": 1e9}, "clustering": {"k": 1},
        "storage": {"max_samples_per_shard": 2, "compact_after_manifest": True}, "datasets": [{"name": "d", "path": f"{tmp_path}/src", "format": "parquet", "label": "auto"}],
    })
    run = curate.Run(spark, cfg)
    run.run()
    rows = run.table("manifest").collect()
    assert len(rows) == run.table("dedup").count() == 3 and all(r["shard"].startswith("d/gen-000001/data-") and r["offset"] > 0 for r in rows)
    got = run.content(run.table("manifest")).collect()
    assert all(bytes(r["content"][:4]) == b"\x89PNG" for r in got)


def test_settings():
    with pytest.raises(config.ConfigError) as e:
        config.read({"balanse": {}, "filters": {"max_tall": "9-23", "min": 1}, "clustering": {"k": True}, "datasets": [{"name": "a", "path": "x", "split": "train"}, {"name": "a", "label": "cat"}]})
    said = str(e.value).split("\n")
    for part in ("balanse: no such section", "filters.min: no such key", "filters.max_tall: '9-23'", "clustering.k: True", "names must differ", "datasets[0].split", "datasets[1].label", "repo_id or path"):
        assert any(part in x for x in said), (part, said)
    cfg = config.read({"datasets": [{"name": "a", "repo_id": "b/c", "label": "column:kind", "label_map": {" Cat ": "real"}}]})
    assert cfg.datasets[0].columns == {"label": "kind"} and cfg.datasets[0].label_map == {"cat": "real"} and cfg.dedup.phash_size == 12 and cfg.balance.val_fraction == 0.02


def test_missing_sources(spark, tmp_path):
    (tmp_path / "src" / "misc").mkdir(parents=True)
    (tmp_path / "src" / "misc" / "a.png").write_bytes(picture("noise", 300))
    for d in ({"path": f"{tmp_path}/none"}, {"repo_id": "a/b"}, {"path": f"{tmp_path}/src", "format": "imagefolder"}):
        cfg = config.read({"runtime": {"work_dir": f"{tmp_path}/w", "data_dir": f"{tmp_path}/data"}, "datasets": [{"name": "d", "label": "folder", **d}]})
        with pytest.raises(config.ConfigError):
            curate.Run(spark, cfg).run()
