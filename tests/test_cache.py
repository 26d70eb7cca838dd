"""The cache: fresh versions are read, stale ones made anew, a lost claim is followed by one other, and failures leave none."""

import os
import threading
import time

import pytest

from quire.sources.cache import cached


def counted(spark):
    made, lock = [], threading.Lock()

    def make(wait=0.0):
        with lock:
            made.append(len(made))
            n = len(made)
        time.sleep(wait)
        return spark.createDataFrame([(n,)], "n int")

    return made, make


def test_cache(spark, tmp_path):
    folder = f"file://{tmp_path}/c"
    made, make = counted(spark)

    def value(**more):
        return cached(spark, folder, make, 1, **more).first().n

    assert value() == 1 and value() == 1 and made == [0]
    assert value(now=lambda: time.time() + 7200) == 2 and value() == 2
    (tmp_path / "c" / "claims" / "3").touch()  # a maker that is gone
    assert value(now=lambda: time.time() + 9000) == 3
    assert sorted(x.name for x in (tmp_path / "c").iterdir()) == ["claims", "v-1", "v-2", "v-4"]

    def fail():
        raise KeyError

    with pytest.raises(KeyError):
        cached(spark, f"file://{tmp_path}/d", fail, 1)
    assert cached(spark, f"file://{tmp_path}/d", make, 1).first().n == 4  # at once: the claim was given up


def test_two_makers_and_a_stale_claim_make_one_version(spark, tmp_path):
    folder = f"file://{tmp_path}/c"
    made, make = counted(spark)
    (tmp_path / "c" / "claims").mkdir(parents=True)
    stale = tmp_path / "c" / "claims" / "1"
    stale.touch()
    os.utime(stale, (time.time() - 1000,) * 2)
    got = []
    threads = [threading.Thread(target=lambda: got.append(cached(spark, folder, lambda: make(1.0), 1, patience=0.6).first().n)) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join(120)
    assert got == [1] * 4 and made == [0] and [x.name for x in (tmp_path / "c").iterdir() if x.name.startswith("v-")] == ["v-2"]


def test_a_late_maker_drops_its_version(spark, tmp_path, monkeypatch):
    from contextlib import nullcontext

    from quire.sources import cache

    folder = f"file://{tmp_path}/c"
    made, make = counted(spark)
    monkeypatch.setattr(cache._Folder, "renewed", lambda self, n, patience: nullcontext())  # a maker that can't renew
    taken = []

    def slow():
        if not taken:
            taken.append(1)
            time.sleep(0.5)
            assert cached(spark, folder, make, 1, patience=0.2).first().n == 1  # another takes over meanwhile
        return make()

    assert cached(spark, folder, slow, 1, patience=0.2).first().n == 1
    assert [x.name for x in (tmp_path / "c").iterdir() if x.name.startswith(("v-", "made"))] == ["v-2"]


def test_a_folder_that_cannot_be_written(spark, tmp_path):
    (tmp_path / "file").write_text("x")
    with pytest.raises(Exception, match="(?i)file|directory|mkdirs"):
        cached(spark, f"file://{tmp_path}/file/c", lambda: spark.range(1), 1)
