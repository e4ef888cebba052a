"""Settings from TOML: one table of keys, one reader that reports all errors at once."""

from __future__ import annotations

import tomllib
from collections.abc import Callable
from dataclasses import dataclass
from types import SimpleNamespace
from typing import Any

from ..functions.ids import parse_ratio


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Key:
    kind: type | tuple[type, ...]
    default: Any = None
    fits: Callable[[Any], bool] = lambda v: True
    wants: str = ""


def one_of(*values: str) -> dict:
    return {"fits": lambda v: v in values, "wants": f"one of {', '.join(map(repr, values))}"}


def at_least(n: float) -> dict:
    return {"fits": lambda v: v >= n, "wants": f"at least {n}"}


def is_ratio(v: str) -> bool:
    try:
        return parse_ratio(v) > 0
    except ValueError:
        return False


NUMBER = (int, float)
# Names, defaults and ranges of the settings.
SECTIONS: dict[str, dict[str, Key]] = {
    "runtime": {
        "work_dir": Key(str, "work"), "data_dir": Key(str, "data"), "num_workers": Key(int, 8, **at_least(1)), "world_size": Key(int, 1, **at_least(1)), "rank": Key(int, 0, **at_least(0)),
        "barrier_timeout_s": Key(NUMBER, 86400.0), "barrier_poll_s": Key(NUMBER, 10.0),
    },
    "download": {"max_workers": Key(int, 1, **at_least(1)), "staging_dir": Key(str, ""), "retain_snapshots": Key(bool, False), "retain_xet_cache": Key(bool, False)},
    "storage": {
        "backend": Key(str, "webdataset", **one_of("webdataset")), "target_shard_bytes": Key(int, 3_000_000_000, **at_least(1 << 20)), "max_samples_per_shard": Key(int, 100_000, **at_least(1)),
        "compact_after_manifest": Key(bool, False),
    },
    "filters": {
        "min_longest_side": Key(int, 256), "max_tall": Key(str, "9:23", is_ratio, "a ratio such as 9:23"), "max_wide": Key(str, "23:9", is_ratio, "a ratio such as 23:9"),
        "laplacian_min": Key(NUMBER, 2.0), "laplacian_max": Key(NUMBER, 15000.0),
    },
    "dedup": {"phash_size": Key(int, 12), "phash_max_hamming": Key(int, 8), "colorhash_max_hamming": Key(int, 6), "keep_removed_files": Key(bool, False)},
    "embedding": {
        "model": Key(str, ""), "batch_size": Key(int, 64, **at_least(1)), "image_size": Key(int, 0, **at_least(0)), "dtype": Key(str, "float16", **one_of("float16", "float32")), "devices": Key(str, "auto"),
        "flush_rows": Key(int, 20_000, **at_least(1)), "concurrency": Key(int, 0, **at_least(0)),
    },
    "daft": {"enabled": Key(bool, False), "runner": Key(str, "native", **one_of("native", "ray")), "ray_address": Key(str, "auto")},
    "clustering": {
        "backend": Key(str, "auto", **one_of("auto", "usearch", "sklearn")), "k": Key(int, 0, **at_least(0)), "aggressiveness": Key(NUMBER, 0.5, lambda v: 0 < v <= 1, "above 0 and at most 1"),
        "prune_trigger_sigma": Key(NUMBER, 3.0, **at_least(0)), "semdedup_threshold": Key(NUMBER, 0.96, lambda v: 0 < v <= 1, "above 0 and at most 1"), "max_ram_gb": Key(NUMBER, 64.0), "seed": Key(int, 42),
    },
    "balance": {
        "max_per_generator": Key(int, 0, **at_least(0)), "per_generator_cluster_cap": Key(int, 0, **at_least(0)), "max_label_ratio": Key(NUMBER, 0.0, **at_least(0)), "val_fraction": Key(NUMBER, 0.02, **at_least(0)),
        "test_fraction": Key(NUMBER, 0.0, **at_least(0)), "seed": Key(int, 42), "emit_csv": Key(bool, True),
    },
}
FORMATS = ("auto", "parquet", "arrow", "jsonl", "zip", "tar", "webdataset", "multipart_zip", "multipart_tar", "imagefolder", "raw")
DATASET: dict[str, Key] = {
    "name": Key(str, "", lambda v: bool(v.strip()), "not empty"), "label": Key(str, "folder", lambda v: v in ("real", "fake", "folder", "auto", "unknown") or v.startswith("column:"), "real, fake, folder, auto, unknown or column:<name>"), "repo_id": Key(str, ""), "path": Key(str, ""), "generator": Key(str, ""), "format": Key(str, "auto", **one_of(*FORMATS)),
    "image_dir": Key(str, ""), "source_split": Key(str, ""), "revision": Key(str, ""), "allow_patterns": Key(list, ()), "keep_archives": Key(bool, False), "allow_delete": Key(bool, False),
    "assign_split": Key(str, "", **one_of("", "train", "val", "test")), "download_only": Key(bool, False), "images": Key(list, ()), "row_filter": Key(dict, {}),
    "row_exclude": Key(dict, {}, lambda v: all(isinstance(x, list) and x for x in v.values()), "lists with values"), "metadata_file": Key(str, ""), "output_column": Key(str, ""), "multipart_glob": Key(str, ""),
    "columns": Key(dict, {}, lambda v: set(v) <= {"image", "label", "generator", "split"}, "of the roles image, label, generator and split"),
    "label_map": Key(dict, {}, lambda v: set(v.values()) <= {"real", "fake"}, "to real or fake"),
}
IMAGE: dict[str, Key] = {"column": Key(str, "", bool, "not empty"), "kind": Key(str, "auto", **one_of("auto", "embedded", "path")), "generator": Key(str, ""), "generator_column": Key(str, "")}


def table(where: str, keys: dict[str, Key], given: Any, errors: list[str]) -> SimpleNamespace:
    """The values of a TOML table, defaults where it has none; what is wrong goes to ``errors``."""
    if not isinstance(given, dict):
        errors.append(f"{where}: must be a table")
        given = {}
    errors += [f"{where}.{name}: no such key" for name in given if name not in keys]
    out = {}
    for name, key in keys.items():
        out[name] = given.get(name, key.default)
        if name not in given and name != "name":
            continue
        if not isinstance(out[name], key.kind) or (isinstance(out[name], bool) and key.kind is not bool):
            errors.append(f"{where}.{name}: {out[name]!r} has the wrong type")
            out[name] = key.default
        elif not key.fits(out[name]):
            errors.append(f"{where}.{name}: {out[name]!r} must be {key.wants}")
            out[name] = key.default
    return SimpleNamespace(**out)


def dataset(where: str, given: Any, errors: list[str]) -> SimpleNamespace:
    if isinstance(given, dict) and "split" in given:
        errors.append(f"{where}.split: say source_split for what to read or assign_split for where rows go")
        given = {k: v for k, v in given.items() if k != "split"}
    d = table(where, DATASET, given, errors)
    d.columns = {role: getattr(d, role)[7:] for role in ("label", "generator") if getattr(d, role).startswith("column:")} | d.columns
    d.label_map = {str(k).strip().lower(): v for k, v in d.label_map.items()}
    d.images = [table(f"{where}.images[{i}]", IMAGE, x, errors) for i, x in enumerate(d.images)]
    rules = (
        (bool(d.repo_id) == bool(d.path), "needs repo_id or path, not both"),
        (any(i.generator and i.generator_column for i in d.images), "an image has generator or generator_column, not both"),
        (d.format == "multipart_zip" and not (d.multipart_glob and d.metadata_file and d.output_column), "multipart_zip needs multipart_glob, metadata_file and output_column"),
        (d.format != "multipart_zip" and bool(d.multipart_glob or d.metadata_file or d.output_column), "multipart_glob, metadata_file and output_column are for multipart_zip"),
        (bool(d.images) and "image" in d.columns, "has images or columns.image, not both"),
        (d.download_only != (d.format == "raw"), "download_only and the format raw go together"),
    )
    errors += [f"{where}: {says}" for broken, says in rules if broken]
    return d


def read(raw: dict) -> SimpleNamespace:
    """Settings by section, and ``datasets``. Raises one ConfigError that lists everything wrong."""
    errors = [f"{name}: no such section" for name in raw if name not in SECTIONS and name != "datasets"]
    cfg = SimpleNamespace(**{name: table(name, keys, raw.get(name, {}), errors) for name, keys in SECTIONS.items()})
    f, b, r = cfg.filters, cfg.balance, cfg.runtime
    names = [d.get("name") for d in raw.get("datasets", []) if isinstance(d, dict)]
    rules = (
        (parse_ratio(f.max_tall) >= parse_ratio(f.max_wide), "filters.max_tall: must be below max_wide"),
        (f.laplacian_min >= f.laplacian_max, "filters.laplacian_min: must be below laplacian_max"),
        (b.val_fraction + b.test_fraction >= 1, "balance: val_fraction and test_fraction leave nothing to train on"),
        (r.rank >= r.world_size, "runtime.rank: must be below world_size"),
        (not names, "datasets: there are none"),
        (len(set(names)) < len(names), "datasets: names must differ"),
    )
    errors += [says for broken, says in rules if broken]
    cfg.datasets = [dataset(f"datasets[{i}]", d, errors) for i, d in enumerate(raw.get("datasets", []))]
    if errors:
        raise ConfigError("\n".join(errors))
    cfg.work_dir, cfg.data_dir = r.work_dir, r.data_dir
    return cfg


def load(path: str) -> SimpleNamespace:
    with open(path, "rb") as f:
        return read(tomllib.load(f))
