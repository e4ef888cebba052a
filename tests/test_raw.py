import os

import numpy as np
import pytest

from sievework.functions import images
from sievework.sources import files, raw


def test_snapshot_and_raw(spark, tmp_path):
    repo, root = tmp_path / "repo", str(tmp_path / "root")
    (repo / "a").mkdir(parents=True)
    (repo / "a" / "x.txt").write_text("1")
    at = raw.snapshot(root, str(repo), raw.local_fetch)
    assert raw.snapshot(root, "nowhere", None) == at and os.path.isfile(os.path.join(at, "a", "x.txt"))
    assert raw.archive_raw(at, root, "d") == 1 and files.dataset_status(spark, root) == "raw_tar_complete"
    assert raw.clean_up(root) >= 1 and not os.path.isdir(at)

    def fails(*a, **b):
        raise OSError("no network")

    with pytest.raises(OSError):
        raw.snapshot(str(tmp_path / "other"), "r", fails)
    assert os.listdir(tmp_path / "other") == []


def test_thumbnail():
    big = images.png_bytes(np.full((600, 300, 3), 7))
    assert images.image_size(images.thumbnail(big)) == (128, 256) and images.thumbnail(b"x") is None
    x = np.arange(27).reshape(3, 3, 3)
    assert (images.decode(images.png_bytes(x)) == x).all()
