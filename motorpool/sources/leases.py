"""Leases: work that one job at a time may do, kept by records that only one job can make and that run out."""

from __future__ import annotations

import contextlib
import threading
import time
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

from motorpool.sources import files

#: Seconds a lease lasts after its last renewal. Clocks of drivers have to agree far better than that.
SECONDS = 600.0
#: Seconds between looks at a lease that another job holds.
PAUSE = 1.0


def record_numbers(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the records of a folder, in order."""
    names = [e.name.removesuffix(".json") for e in files.listing(spark, folder)]
    return sorted(int(n) for n in names if n.isdigit())


class Lease:
    """The right to one kind of work, held for one epoch.

    An epoch is a record made by create-if-absent, so of two jobs that want it one gets it. The highest epoch counts;
    it is over once it is released or has not been renewed in time, so a killed job blocks nobody for long. A job that
    was overtaken notices by the higher epoch, and `check` raises before its next write.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, seconds: float = SECONDS) -> None:
        self.spark, self.seconds = spark, seconds
        self.folder = f"{root}/_leases/{name}"
        self.holder = uuid.uuid4().hex
        self.epoch = 0
        self._over = threading.Event()

    def _path(self, epoch: int) -> str:
        return f"{self.folder}/{epoch:08d}.json"

    def _state(self) -> tuple[int, bool]:
        """The highest epoch, and whether somebody holds it."""
        last = max(record_numbers(self.spark, self.folder), default=0)
        record = files.read_json(self.spark, self._path(last)) if last else None
        return last, record is not None and record["until"] > time.time()

    def held(self) -> bool:
        return self._state()[1]

    def _record(self) -> dict:
        return {"holder": self.holder, "until": time.time() + self.seconds}

    def take(self) -> bool:
        last, held = self._state()
        if held or not files.create_whole(self.spark, self._path(last + 1), self._record()):
            return False
        self.epoch = last + 1
        if not self.mine():
            return False
        for old in record_numbers(self.spark, self.folder):
            if old < last:
                files.drop(self.spark, self._path(old))
        return True

    def mine(self) -> bool:
        if max(record_numbers(self.spark, self.folder), default=0) != self.epoch:
            return False
        return (files.read_json(self.spark, self._path(self.epoch)) or {}).get("holder") == self.holder

    def check(self) -> None:
        if not self.mine():
            raise RuntimeError(f"another job took over {self.folder}: this one was silent for more than {self.seconds} seconds")

    def renew(self) -> None:
        self.check()
        files.replace_json(self.spark, self._path(self.epoch), self._record())

    def _keep(self) -> None:
        while not self._over.wait(self.seconds / 4):
            try:
                self.renew()
            except Exception:  # overtaken, or the session has ended: `check` tells the job
                return

    def release(self) -> None:
        if self.mine():
            files.replace_json(self.spark, self._path(self.epoch), {"holder": self.holder, "until": 0})

    @contextlib.contextmanager
    def hold(self, wait: float = 0.0) -> Iterator[Lease]:
        """Take the lease, waiting up to `wait` seconds for another job, and renew it until the work inside is done."""
        last = time.monotonic() + wait
        while not self.take():
            if time.monotonic() >= last:
                raise RuntimeError(f"another job holds {self.folder}; its lease ends {self.seconds:.0f} seconds after it is gone")
            time.sleep(min(PAUSE, max(0.0, last - time.monotonic())))
        keeper = threading.Thread(target=self._keep, daemon=True)
        keeper.start()
        try:
            yield self
        finally:
            self._over.set()
            keeper.join()
            self.release()
