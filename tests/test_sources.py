import io
import json
import os
import struct
import tarfile
import zipfile
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sievework.functions import images
from sievework.sources import files, shards, urls


def png(x: np.ndarray) -> bytes:
    h, w, _ = x.shape
    chunk = lambda n, b: struct.pack(">I", len(b)) + n + b + struct.pack(">I", zlib.crc32(n + b))
    raw = b"".join(b"\0" + x[y].astype(np.uint8).tobytes() for y in range(h))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def picture(kind: str, n: int = 64) -> bytes:
    ramp = np.tile(np.linspace(0, 255, n), (n, 1))
    if kind == "flat":
        x = np.full((n, n, 3), 128)
    elif kind == "noise":
        x = np.random.default_rng(1).integers(0, 256, (n, n, 3))
    else:
        x = np.stack([ramp, ramp.T, ramp * 0], 2)
        if kind == "circle":
            y, z = np.mgrid[:n, :n]
            x[(y - n / 2) ** 2 + (z - n / 2) ** 2 < (n / 4) ** 2] = (255, 0, 0)
    return png(x)


def test_image_functions():
    b = picture("gradient")
    assert images.image_size(b) == (64, 64) and images.decode(b).shape == (64, 64, 3) and images.image_size(b"junk") is None
    assert images.laplacian_variance(images.decode(picture("flat"))) == 0 < images.laplacian_variance(images.decode(picture("noise")))
    small, big = (images.perceptual_hash(images.decode(picture("circle", n))) for n in (96, 144))
    noise = images.perceptual_hash(images.decode(picture("noise")))
    far = lambda a, c: sum((x ^ y).bit_count() for x, y in zip(a, c))
    assert len(small) == 18 and far(small, big) <= 8 < far(small, noise)
    assert len(images.colour_hash(images.decode(b))) == 6


def test_fingerprints(spark):
    df = spark.createDataFrame([(1, bytearray(picture("noise"))), (2, bytearray(b"broken"))], "image_id long, content binary")
    got = {r["image_id"]: r for r in images.fingerprints(df, ["image_id"]).collect()}
    assert got[1]["laplacian"] > 2 and got[2]["laplacian"] is None and got[2]["file_hash"] is not None
    sizes = {r["image_id"]: (r["width"], r["broken"]) for r in images.with_headers(df).collect()}
    assert sizes == {1: (64, False), 2: (None, True)}
    assert images.embed(df, ["image_id"], images.pixel_embedder, 64).count() == 1


def test_archives_and_parts(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("real/x.png", b"1")
        z.writestr("../evil.png", b"2")
        z.writestr("note.txt", b"3")
    got = [tuple(r)[:2] for r in files.read_archives(spark, str(tmp_path)).collect()]
    assert got == [("a", "real/x.png")]
    raw = io.BytesIO()
    with tarfile.open(fileobj=raw, mode="w") as t:
        for i in range(2):
            info = tarfile.TarInfo(f"m{i}.png")
            info.size = 700
            t.addfile(info, io.BytesIO(bytes([i]) * 700))
    parts = tmp_path / "parts"
    parts.mkdir()
    data = raw.getvalue()
    for i, piece in enumerate((data[:900], data[900:1500], data[1500:])):
        (parts / f"big.tar.{i}").write_bytes(piece)
    rows = files.read_archives(spark, str(parts), parts=r"^big\.tar\.\d+$").collect()
    assert [(r["name"], bytes(r["content"])) for r in rows] == [("m0.png", b"\0" * 700), ("m1.png", b"\1" * 700)]
    meta = spark.createDataFrame([(["./m0.png", "gone.png"],)], "o array<string>")
    arch = files.read_archives(spark, str(parts), parts=r"^big\.tar\.\d+$")
    assert files.named_members(arch, meta, "o").count() == 1
    assert files.missing_members(arch, spark.createDataFrame([("gone.png",)], "o string"), "o") == 1


def test_arrow_and_jsonl(spark, tmp_path):
    t = pa.table({"a": [1, 2, 3]})
    for name, make in (("s.arrow", pa.ipc.new_stream), ("f.arrow", pa.ipc.new_file)):
        with make(str(tmp_path / name), t.schema) as w:
            w.write_table(t)
    assert files.read_arrow(spark, str(tmp_path)).groupBy().sum("a").first()[0] == 12
    j = tmp_path / "j"
    j.mkdir()
    (j / "x.jsonl").write_text('{"a": "1"}\n\n{"a": "2"}\n')
    assert files.read_jsonl(spark, str(j), ["a"]).count() == 2
    (j / "bad.jsonl").write_text("{nope\n")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(j), ["a"]).collect()


def test_column_matching(spark):
    df = spark.createDataFrame([], "jpeg struct<bytes:binary,path:string>, picture binary, class string, model_name string")
    assert files.match_columns(df) == {"image": "picture", "label": "class", "generator": "model_name"}
    with pytest.raises(ValueError):
        files.match_columns(df, {"image": "nope"})
    with pytest.raises(ValueError):
        files.match_columns(spark.createDataFrame([], "a string"))
    assert files.split_files(["a/train-0.parquet", "a/test-0.parquet"], "test") == ["a/test-0.parquet"]
    assert files.split_files(["a/x.parquet"], "test") == ["a/x.parquet"]


def samples(spark, ids):
    rows = [(i, f"d/{i}.png", "d", "real", "g", "", ".png", bytearray(bytes([i]) * (i * 100)), "{}") for i in ids]
    return spark.createDataFrame(rows, shards.SAMPLE)


def test_shards(spark, tmp_path):
    root = str(tmp_path / "s")
    index = shards.write_shards(samples(spark, [1, 2, 3]).coalesce(1), root, name="d", most_rows=2)
    assert [r["n"] for r in index.groupBy("shard").agg(F.count("*").alias("n")).orderBy("shard").collect()] == [2, 1]
    got = {r["image_id"]: bytes(r["content"]) for r in files.read_ranges(index, root).collect()}
    assert got == {i: bytes([i]) * (i * 100) for i in (1, 2, 3)}
    assert shards.write_shards(samples(spark, [3, 4]).coalesce(1), root, name="d").count() == 4
    shards.write_descriptor(index, root, "d")
    assert files.dataset_status(spark, root) == "webdataset_complete"
    out = shards.compact(spark, root, spark.createDataFrame([(1,), (4,)], "image_id long"), name="d")
    assert {r["image_id"]: bytes(r["content"]) for r in files.read_ranges(out, root).collect()} == {1: b"\1" * 100, 4: b"\4" * 400}
    with pytest.raises(ValueError):
        shards.compact(spark, root, spark.createDataFrame([], "image_id long"), name="d")
    assert not [f for f in os.listdir(root) if f.endswith(".partial")]

    def stop():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        shards.compact(spark, root, spark.createDataFrame([(4,)], "image_id long"), name="d", before_switch=stop)
    assert {r["image_id"] for r in files.read_ranges(shards.read_index(spark, root), root).collect()} == {1, 4}
    out = shards.compact(spark, root, spark.createDataFrame([(4,)], "image_id long"), name="d")
    assert [(r["image_id"], bytes(r["content"])) for r in files.read_ranges(out, root).collect()] == [(4, b"\4" * 400)]
    assert [f for f in sorted(os.listdir(root)) if f.startswith("gen-")] == ["gen-000002"] and files.dataset_status(spark, root) == "webdataset_complete"
    assert shards.migrate(spark, samples(spark, []), str(tmp_path / "none"), "d") == "needs_download"
    assert shards.migrate(spark, samples(spark, [1]), root, "d") == "already_complete"


def test_manifest_guard_and_flags(spark, tmp_path):
    df = spark.range(40)
    assert shards.write_manifest(df, str(tmp_path)) and not shards.write_manifest(df, str(tmp_path), most_rows=5)
    assert not (tmp_path / "manifest_csv").exists()
    f = shards.Flags(str(tmp_path / "flags.json"))
    assert f.toggle("1") and shards.Flags(f.path).ids == {"1"} and not f.toggle("1")


def test_urls(spark):
    df = spark.createDataFrame([("1", "http://a/x", True), ("2", "ftp://a", True), ("3", "https://b/y", False), ("4", "not a url", None)], "id string, u string, ok boolean")
    assert [r["url"] for r in urls.url_rows(df, "u", id_col="id", required_true="ok").collect()] == ["http://a/x"]
    now, slept = [0.0], []
    p = urls.Pacer(2.0, lambda: now[0], lambda s: (slept.append(s), now.__setitem__(0, now[0] + s)))
    p.wait()
    p.wait()
    now[0] += 0.5
    p.wait()
    assert slept == [2.0, 1.5]
    answers = iter([(503, {"Retry-After": "1"}, b""), (200, {}, b"ok")])
    assert urls.fetch_one("u", lambda u: next(answers), p, 2, 10) == (b"ok", "")
    assert urls.fetch_one("u", lambda u: (404, {}, b""), p, 9, 10) == (None, "http_404")
    assert urls.retry_delay(9, None) == 30 and urls.retry_delay(0, "500") == 120


def test_unsigned(spark):
    df = spark.sql("select cast(x as decimal(20,0)) x from values (18446744073709551615), (5) t(x)")
    assert [r[0] for r in files.unsigned_ids(df, "x").collect()] == [-1, 5]


def test_curation_flow(spark, tmp_path):
    from sievework.plans import curate, config, viewer

    src = tmp_path / "src"
    for label, kinds in (("real", ("gradient", "flat", "circle")), ("fake/sd", ("noise",))):
        (src / label).mkdir(parents=True)
        for k in kinds:
            (src / label / f"{k}.png").write_bytes(picture(k, 300))
    (src / "real" / "copy.png").write_bytes(picture("circle", 300))
    (src / "real" / "big.png").write_bytes(picture("circle", 400))
    (src / "real" / "broken.png").write_bytes(b"x")
    toml = tmp_path / "c.toml"
    toml.write_text(f'[runtime]\nwork_dir = "{tmp_path}/work"\ndata_dir = "{tmp_path}/data"\n[filters]\nlaplacian_min = 0.0001\nlaplacian_max = 1e9\n[[datasets]]\nname = "d"\npath = "{src}"\n[clustering]\nk = 2\n')
    run = curate.Run(spark, config.load(str(toml)))
    assert set(run.run().values()) == {"done"}
    assert set(run.run().values()) == {"skipped"}
    run.cfg.clustering.k = 1
    assert [k for k, v in run.run().items() if v == "done"] == ["cluster", "manifest"]
    assert {r["reason"] for r in run.table("headerscan").where("reason is not null").collect()} == {"broken_header"}
    assert "laplacian_low" in {r["reason"] for r in run.table("fingerprint").collect()}
    kept = {os.path.basename(r["path"]) for r in run.table("dedup").collect()}
    assert "big.png" in kept and not {"copy.png", "circle.png"} & kept and "noise.png" in kept
    assert run.table("manifest").count() == run.table("dedup").count()
    assert curate.main(["run", "--config", str(toml), "--dry-run"]) == 0 and curate.main(["run", "--config", str(tmp_path / "none")]) == 2
    with pytest.raises(ValueError):
        viewer.serve(None, "0.0.0.0")
    pts = viewer.points(run.table("cluster"), run.table("embed"), run.table("dedup"))
    v = viewer.Viewer(pts, run.table("removed").selectExpr("'dedup' kind", "image_id pruned_image_id", "kept_image_id", "-1 cluster_id"), run.table("cluster_summary"), str(tmp_path / "f.json"))
    assert v.get("/api/pairs", {"page": "99", "size": "1"})[1]["rows"] == [] and v.get("/api/nope", {})[0] == 404
    assert json.dumps(v.get("/api/points", {})[1]) and v.post("/api/flag/7")[1] == {"flagged": True}


def test_stream_ingest(spark, tmp_path):
    from sievework.streaming.ingest import ingest

    df = spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "image_id long, x string")
    df.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        ingest(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    df.write.mode("append").parquet(str(tmp_path / "in"))
    ingest(spark, str(tmp_path / "in"), df.schema, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
