"""Tables for a viewer, and a small JSON server over them on the loopback interface."""

from __future__ import annotations

import json
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import parse_qs, urlparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import balance, tables
from ..sources.shards import Flags


def project(df: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` with x and y: two principal components."""
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    v = df.withColumn("_v", array_to_vector(F.col(vector)))
    out = PCA(k=2, inputCol="_v", outputCol="_p").fit(v).transform(v).withColumn("_p", vector_to_array("_p"))
    return out.withColumn("x", F.get("_p", F.lit(0)).cast("float")).withColumn("y", F.get("_p", F.lit(1)).cast("float")).drop("_v", "_p")


def points(assignments: DataFrame, embeddings: DataFrame, meta: DataFrame, *, sample: int = 200_000, floor: int = 20, seed: int = 42) -> DataFrame:
    """Sampled points by cluster with coordinates and metadata; unknown metadata is empty."""
    sizes = assignments.groupBy("cluster_id").agg(F.count("*").alias("size"))
    drawn = balance.stratified_sample(assignments, balance.stratum_quotas(sizes, sample, floor), seed=seed)
    flat = project(drawn.join(embeddings, "image_id")).drop("embedding").join(meta.select("image_id", "path", "generator", "dataset", "label"), "image_id", "left")
    return flat.select("image_id", F.coalesce("path", F.lit("")).alias("path"), "x", "y", "cluster_id", "pruned", *(F.coalesce(c, F.lit("")).alias(c) for c in ("generator", "dataset", "label")))


def screen_cells(pts: DataFrame, cell: float, hide_pruned: bool = False) -> DataFrame:
    rows = pts.where(~F.col("pruned")) if hide_pruned else pts
    return rows.groupBy(F.floor(F.col("x") / cell).alias("cx"), F.floor(F.col("y") / cell).alias("cy")).agg(F.count("*").alias("n"))


class Viewer:
    """Answers of the API; ids are text, as they don't fit JavaScript's numbers."""

    def __init__(self, pts: DataFrame, pairs: DataFrame, summary: DataFrame, flags: str):
        self.pts, self.pairs, self.summary, self.flags = pts, pairs, summary, Flags(flags)

    @staticmethod
    def rows(df: DataFrame) -> list[dict]:
        return [{k: str(v) if k.endswith("image_id") else v for k, v in r.asDict().items()} for r in df.collect()]

    def get(self, path: str, q: dict[str, str]):
        part = path.strip("/").split("/")
        if part[:2] == ["api", "points"]:
            return 200, self.rows(self.pts)
        if part[:2] == ["api", "clusters"]:
            return 200, self.rows(self.summary.orderBy(F.desc("size")))
        if part[:3] == ["api", "pairs", "summary"]:
            return 200, self.rows(tables.pairs_summary(self.pairs))
        if part[:2] == ["api", "pairs"]:
            df = self.pairs
            if "kind" in q:
                df = df.where(F.col("kind") == q["kind"])
            if "cluster" in q:
                df = df.where(F.col("cluster_id") == int(q["cluster"]))
            number, size = max(0, int(q.get("page", 0))), min(100, max(1, int(q.get("size", 24))))
            return 200, {"total": df.count(), "rows": self.rows(df.orderBy("pruned_image_id").offset(number * size).limit(size))}
        if part[:2] == ["api", "flags"]:
            return 200, sorted(self.flags.ids)
        if part[:2] == ["api", "cluster"] and part[3:] == ["examples"]:
            return 200, self.rows(tables.examples(self.pts, int(part[2]), int(q.get("n", 24))))
        if part[:2] == ["api", "path"] and len(part) == 3:
            found = self.rows(self.pts.where(F.col("image_id").cast("string") == part[2]).select("path").limit(1))
            return (200, found[0]) if found else (404, {"error": "unknown id"})
        return 404, {"error": "unknown path"}

    def post(self, path: str):
        part = path.strip("/").split("/")
        if part[:2] == ["api", "flag"] and len(part) == 3:
            return 200, {"flagged": self.flags.toggle(part[2])}
        return 404, {"error": "unknown path"}


def serve(viewer: Viewer, host: str = "127.0.0.1", port: int = 8765, allow_remote: bool = False) -> ThreadingHTTPServer:
    """A server that is ready to serve_forever(). Other hosts than the own one must be allowed."""
    if host not in ("127.0.0.1", "localhost", "::1") and not allow_remote:
        raise ValueError("refusing to serve other hosts")

    class Handler(BaseHTTPRequestHandler):
        def answer(self, status: int, body) -> None:
            data = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Type", "application/json")
            self.send_header("Content-Length", str(len(data)))
            self.end_headers()
            self.wfile.write(data)

        def do_GET(self) -> None:
            u = urlparse(self.path)
            self.answer(*viewer.get(u.path, {k: v[0] for k, v in parse_qs(u.query).items()}))

        def do_POST(self) -> None:
            self.answer(*viewer.post(urlparse(self.path).path))

        def log_message(self, *args) -> None:
            pass

    return ThreadingHTTPServer((host, port), Handler)
