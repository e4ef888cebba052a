"""Snapshots of repositories by a pluggable fetcher, and raw archives of whole folders."""

from __future__ import annotations

import os
import shutil
import tarfile
from collections.abc import Callable

from .files import listed
from .shards import put_json


def snapshot(root: str, repo: str, fetch: Callable[..., None], *, revision: str | None = None, allow_patterns: list[str] | None = None, workers: int = 1) -> str:
    """Folder of a repository's files: the one that is there, else what ``fetch`` puts into it. A fetch that fails leaves nothing behind."""
    final, partial = os.path.join(root, "snapshot"), os.path.join(root, "snapshot.partial")
    if not os.path.isdir(final):
        shutil.rmtree(partial, ignore_errors=True)
        os.makedirs(partial)
        try:
            fetch(repo, partial, revision=revision, allow_patterns=allow_patterns, max_workers=workers)
        except BaseException:
            shutil.rmtree(partial, ignore_errors=True)
            raise
        os.replace(partial, final)
    return final


def local_fetch(repo: str, target: str, **_) -> None:
    """Fetcher of a repository that is a local folder."""
    shutil.copytree(repo, target, dirs_exist_ok=True)


def archive_raw(folder: str, root: str, name: str) -> int:
    """One tar of all files of a folder, put in place after its members are counted; returns their number."""
    os.makedirs(root, exist_ok=True)
    partial, paths = os.path.join(root, f"{name}.tar.partial"), listed(folder)
    with tarfile.open(partial, "w", format=tarfile.USTAR_FORMAT) as t:
        for p in paths:
            t.add(p, os.path.relpath(p, folder))
    with tarfile.open(partial) as t:
        found = sum(1 for m in t if m.isfile())
    if found != len(paths):
        os.remove(partial)
        raise OSError(f"{found} members instead of {len(paths)}")
    os.replace(partial, os.path.join(root, f"{name}.tar"))
    put_json(os.path.join(root, "marker.json"), {"state": "raw", "samples": found})
    return found


def clean_up(root: str, keep_snapshot: bool = False) -> int:
    """Removes partial shards, the snapshot unless it is kept, and empty folders; returns how many were removed."""
    n = 0
    for p in listed(root, (".partial", ".new")):
        os.remove(p)
        n += 1
    at = os.path.join(root, "snapshot")
    if not keep_snapshot and os.path.isdir(at):
        shutil.rmtree(at)
        n += 1
    for d, _, _ in sorted(os.walk(root), reverse=True):
        if d != root and not os.listdir(d):
            os.rmdir(d)
            n += 1
    return n
