"""A cache of tables that cost much to make (directory listings, remote catalogues), with an age limit and a lease."""

from __future__ import annotations

import re
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


class _Folder:
    """The folder's files: claims/n (who makes version n, made exclusively and renewed while it is made), claims/n-free (given up) and
    v-n (a complete version)."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):  # noqa: ANN201
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}" if name else self.folder)

    def changed(self, name: str) -> float:
        return self.fs.getFileStatus(self.path(name)).getModificationTime() / 1000

    def numbers(self, name: str, shape: str) -> list[int]:
        if not self.fs.exists(self.path(name)):
            return []
        found = (re.fullmatch(shape, x.getPath().getName()) for x in self.fs.listStatus(self.path(name)))
        return sorted(int(m[1]) for m in found if m)

    def newest(self) -> tuple[float, int] | None:
        """The time and number of the newest version."""
        versions = self.numbers("", r"v-(\d+)")
        return (self.changed(f"v-{versions[-1]}"), versions[-1]) if versions else None

    def claim(self) -> int:
        """The number of the last claim."""
        return max(self.numbers("claims", r"(\d+)"), default=0)

    def live(self, n: int, now: float, patience: float) -> bool:
        if not n or self.fs.exists(self.path(f"claims/{n}-free")) or self.fs.exists(self.path(f"v-{n}")):
            return False
        return now - self.changed(f"claims/{n}") <= patience

    def take(self, n: int, token: str) -> bool:
        """Claim n, which only one can; an error if it is not another's claim that is in the way."""
        self.fs.mkdirs(self.path("claims"))
        try:
            out = self.fs.create(self.path(f"claims/{n}"), False)
        except Exception:
            if self.fs.exists(self.path(f"claims/{n}")):
                return False
            raise
        out.write(bytearray(token.encode()))
        out.close()
        return True

    def free(self, n: int) -> None:
        self.fs.create(self.path(f"claims/{n}-free"), True).close()

    @contextmanager
    def renewed(self, n: int, patience: float) -> Iterator[None]:
        """Renews claim n while its version is made, so that only a maker that is gone seems lost."""
        done = threading.Event()

        def renew() -> None:
            while not done.wait(max(0.05, patience / 4)):
                self.fs.setTimes(self.path(f"claims/{n}"), int(time.time() * 1000), -1)

        thread = threading.Thread(target=renew, daemon=True)
        thread.start()
        try:
            yield
        finally:
            done.set()
            thread.join()


def cached(spark: SparkSession, folder: str, make: Callable[[], DataFrame], hours: float, patience: float = 600, now: Callable[[], float] = time.time) -> DataFrame:
    """SC15: the newest version under folder if it is younger than so many hours, else a new one from make().

    A version is made by the holder of a lease: claim n, a file that can be made once. Others wait for version n. A claim that nobody
    has renewed for patience seconds is lost: the next claim, n + 1, is open to all, and one gets it; nobody removes another's claim. A
    maker whose claim is not the last any more (it was taken for lost) drops what it made, and versions are renamed into place when
    they are complete, so a reader sees neither half a version nor a late one. A folder that can't be written is an error."""
    place = _Folder(spark, folder)
    token = uuid.uuid4().hex
    while True:
        have = place.newest()
        if have and now() - have[0] < hours * 3600:
            return spark.read.parquet(f"{folder}/v-{have[1]}")
        last = place.claim()
        if place.live(last, now(), patience):
            time.sleep(0.2)
            continue
        n = last + 1
        if not place.take(n, token):
            continue
        seen = place.newest()
        if seen and seen != have:  # another maker has finished meanwhile
            place.free(n)
            continue
        half = f"made-{n}-{token}"
        try:
            with place.renewed(n, patience):
                make().write.parquet(f"{folder}/{half}")
            if place.claim() == n and place.fs.rename(place.path(half), place.path(f"v-{n}")):
                return spark.read.parquet(f"{folder}/v-{n}")
        finally:
            place.fs.delete(place.path(half), True)
            place.free(n)
