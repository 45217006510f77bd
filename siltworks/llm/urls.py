"""URL filters: a sorted array of 64-bit digests, memory-mapped and probed by binary search.

A rule is a host, for itself and its subdomains, and the start of a path. The rules become two files: digests in
ascending order, and the rules' strings in the same order. Spark ships the files to every executor, where tasks
map them into memory, so an executor holds one copy however many tasks it runs and however long the list is.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm.tables import arrow_map

ALLOW, BLOCK = "allow", "block"
_SEPARATOR = "\n"  # between host and path in a digest: no host or rule has one


def _digest(host: str, path: str) -> int:
    return xxhash.xxh64_intdigest(f"{host}{_SEPARATOR}{path}".encode("utf-8", "surrogatepass"))


def split_rule(rule: str) -> tuple[str, str]:
    """``net/es/`` is the host ``net`` and the path ``/es/``."""
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def ship_rules(spark: SparkSession, rules: Iterable[tuple[str, str]]) -> str:
    """Write the rules (verdict, rule) as sorted files and hand them to the executors; returns the list's name.

    A rule given twice with two verdicts is an error. Rules are a list that its owner keeps, at most a few
    hundred megabytes; they do not grow with the pages.
    """
    verdicts: dict[str, str] = {}
    for verdict, rule in rules:
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"a verdict is allow or block, not {verdict!r}")
        if verdicts.setdefault(rule, verdict) != verdict:
            raise ValueError(f"two verdicts for {rule!r}")
    entries = sorted((_digest(*split_rule(rule)), rule, verdict) for rule, verdict in verdicts.items())
    name = f"url-rules-{uuid.uuid4().hex}"
    home = tempfile.mkdtemp(prefix="siltworks-")  # of the driver alone: addFile serves the files from here
    np.save(f"{home}/{name}.npy", np.array([e[0] for e in entries], dtype=np.uint64))
    strings = [json.dumps([e[1], e[2]]).encode() for e in entries]
    np.save(f"{home}/{name}-at.npy", np.cumsum([0, *map(len, strings)], dtype=np.int64))
    with open(f"{home}/{name}.txt", "wb") as file:
        file.write(b"".join(strings))
    with open(f"{home}/{name}.json", "w") as file:
        json.dump(sorted({len(split_rule(r)[1]) for r in verdicts}), file)
    for suffix in (".npy", "-at.npy", ".txt", ".json"):
        spark.sparkContext.addFile(f"{home}/{name}{suffix}")
    return name


class _Rules:
    """The files of a list, mapped into memory."""

    def __init__(self, name: str):
        root = SparkFiles.getRootDirectory()
        self.digests = np.load(f"{root}/{name}.npy", mmap_mode="r")
        self.at = np.load(f"{root}/{name}-at.npy", mmap_mode="r")
        path = f"{root}/{name}.txt"
        self.strings = np.memmap(path, dtype=np.uint8, mode="r") if os.path.getsize(path) else np.zeros(0, np.uint8)
        with open(f"{root}/{name}.json") as file:
            self.path_lengths = json.load(file)

    def rule(self, i: int) -> tuple[str, str]:
        return tuple(json.loads(self.strings[self.at[i] : self.at[i + 1]].tobytes()))

    def probe(self, urls: Sequence[tuple[str, str]]) -> Iterator[tuple[str | None, str | None]]:
        """For each (host, path) the longest rule that fits and its verdict."""
        owner, candidates, digests = [], [], []
        for row, (host, path) in enumerate(urls):
            starts = {path[:n] for n in self.path_lengths if n <= len(path)}
            while host:
                for start in starts:
                    owner.append(row)
                    candidates.append((host, start))
                    digests.append(_digest(host, start))
                _, _, host = host.partition(".")
        best: dict[int, tuple[tuple[int, int], str, str]] = {}
        keys = np.array(digests, dtype=np.uint64)
        first = np.searchsorted(self.digests, keys, side="left")
        last = np.searchsorted(self.digests, keys, side="right")
        for k in np.flatnonzero(last > first):
            host, path = candidates[k]
            for i in range(first[k], last[k]):  # more than one only where digests collide
                rule, verdict = self.rule(i)
                if split_rule(rule) == (host, path):
                    found = ((len(rule), len(host)), rule, verdict)
                    best[owner[k]] = max(best.get(owner[k], found), found)
        for row in range(len(urls)):
            yield best[row][1:] if row in best else (None, None)


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path; both are empty without ``://``."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    ends = [i for i in (rest.find(c) for c in "/?#") if i >= 0]
    host, rest = (rest[: min(ends)], rest[min(ends) :]) if ends else (rest, "")
    ends = [i for i in (rest.find(c) for c in "?#") if i >= 0]
    lower = host.translate({c: c + 32 for c in range(65, 91)})
    return lower, rest[: min(ends)] if ends else rest


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], default: str = ALLOW) -> DataFrame:
    """Per page: ``page_id, host, path, rule, verdict``. The longest rule that fits decides, else ``default``.

    Equally long rules: the one with the longer host. No shuffle; one pass in Arrow batches. A NULL or
    relative url has an empty host and path, which no rule fits. Repeated rows are judged alike.
    """
    name = ship_rules(pages.sparkSession, rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _Rules(name)
        for batch in batches:
            parts = [split_url(url) for url in batch.column(1).to_pylist()]
            found = list(table.probe(parts))
            columns = [
                batch.column(0),
                pa.array([p[0] for p in parts], pa.string()),
                pa.array([p[1] for p in parts], pa.string()),
                pa.array([rule for rule, _ in found], pa.string()),
                pa.array([verdict or default for _, verdict in found], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "host", "path", "rule", "verdict"])

    kind = pages.schema["page_id"].dataType.simpleString()
    schema = f"page_id {kind}, host string, path string, rule string, verdict string"
    return arrow_map(pages.select("page_id", F.col("url").cast("string")), judge, schema)
