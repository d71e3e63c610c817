"""URL filter: sorted arrays of digests, memory-mapped and probed by binary search.

Each rule ``host + path`` has a 64-bit xxhash. The sorted digests of a block of rules
are one ``.npy`` file and their strings another; Spark ships both to the executors,
which map them into memory, so that the workers of a machine share one copy. The keys a
url can fit (each suffix of its host at a dot, with each rule path length that its own
path reaches) are probed together by ``searchsorted``; a hit counts only if the stored
string is the key. Rules beyond ``block_bytes`` take further blocks, and a pass over the
pages each. Pages are never shuffled.

The longest rule that fits wins (host and path together; then the longer host). A url
that fits none is allowed: the list is all that this method knows. A null url, or one
without ``://``, has an empty host and path and fits no rule. Rules with a null host,
path or verdict are left out; of repeated rules with unlike verdicts, ``block`` wins.
"""

import io
import uuid

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from centstream.session import new_folder

BLOCK_BYTES = 16 << 20
PARTS = ("digest", "end", "text", "reach", "host")
RESULT = "page_id long, host string, path string, rule string, verdict string"
NAMES = ["page_id", "host", "path", "rule", "verdict"]

_open: dict[str, tuple] = {}


def _digest(key: str) -> int:
    return xxhash.xxh64_intdigest(key.encode("utf-8", "surrogatepass"))


def block_arrays(rules: list[tuple[str, str, str]]) -> dict[str, np.ndarray]:
    """Arrays of one block of (host, path, verdict), by the part of the file name."""
    by_key = {}
    for host, path, verdict in sorted(rules):
        by_key[(host, path)] = "block" if by_key.get((host, path)) == "block" else verdict
    rows = sorted((_digest(h + p), h, p, v) for (h, p), v in by_key.items())
    texts = ["\n".join((h, p, v)).encode() for _, h, p, v in rows]
    return {
        "digest": np.array([d for d, *_ in rows], np.uint64),
        "end": np.cumsum([len(t) for t in texts], dtype=np.int64),
        "text": np.frombuffer(b"".join(texts), np.uint8),
        "reach": np.unique([len(p) for _, _, p, _ in rows]).astype(np.int64),
        "host": np.array([max((len(h) for _, h, _, _ in rows), default=0)], np.int64),
    }


def _mapped(name: str) -> tuple:
    if name not in _open:
        paths = (SparkFiles.get(f"{name}-{part}.npy") for part in PARTS)
        _open[name] = tuple(_load(path) for path in paths)
    return _open[name]


def _load(path: str) -> np.ndarray:
    try:
        return np.load(path, mmap_mode="r")
    except ValueError:  # an empty array can't be mapped
        return np.load(path)


def parts_of(url: str | None) -> tuple[str, str]:
    """Host, its ASCII letters lower-cased, and path."""
    if url is None or (at := url.find("://")) < 0:
        return "", ""
    rest = url[at + 3 :]
    for mark in "?#":
        rest = rest.partition(mark)[0]
    host, slash, path = rest.partition("/")
    return host.translate(_LOWER), slash + path


_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def probe(urls: list[tuple[str, str]], block: tuple) -> list[tuple[str, str, str] | None]:
    """Longest fitting (host, path, verdict) of each (host, path)."""
    digests, ends, text, reach, longest = block
    owners, hosts, paths = [], [], []
    reaches, most = reach.tolist(), int(longest[0])
    for i, (host, path) in enumerate(urls):
        # A suffix longer than every rule's host fits none.
        at = 0 if len(host) <= most else host.find(".", len(host) - most - 1) + 1 or len(host) + 1
        while at <= len(host):
            for length in reaches:
                if length > len(path):
                    break
                owners.append(i)
                hosts.append(host[at:])
                paths.append(path[:length])
            dot = host.find(".", at)
            at = dot + 1 if dot >= 0 else len(host) + 1
    best: list[tuple[str, str, str] | None] = [None] * len(urls)
    keys = np.array([_digest(h + p) for h, p in zip(hosts, paths, strict=True)], np.uint64)
    low = np.searchsorted(digests, keys, "left")
    high = np.searchsorted(digests, keys, "right")
    for k in np.flatnonzero(high > low).tolist():
        for at in range(low[k], high[k]):
            begin = int(ends[at - 1]) if at else 0
            stored = bytes(text[begin : int(ends[at])]).decode().split("\n")
            if stored[0] == hosts[k] and stored[1] == paths[k]:
                best[owners[k]] = _longer(best[owners[k]], tuple(stored))
    return best


def _longer(a: tuple | None, b: tuple | None) -> tuple | None:
    rank = lambda r: (len(r[0]) + len(r[1]), len(r[0]))
    return max((r for r in (a, b) if r), key=rank, default=None)


def _write(spark: SparkSession, path: str, data: bytes) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = files.create(target, True)
    try:
        out.write(data)
    finally:
        out.close()


def _blocks(rules: DataFrame, block_bytes: int):
    """Names of shipped blocks; the rules pass through the driver a block at a time."""
    context = rules.sparkSession.sparkContext
    own, size, made = [], 0, 0
    good = rules.select("host", "path", "verdict").dropna()

    def ship():
        name, folder = f"urls-{uuid.uuid4().hex}", new_folder(rules.sparkSession, "url-rules")
        for part, values in block_arrays(own).items():
            file = io.BytesIO()
            np.save(file, values)
            path = f"{folder}/{name}-{part}.npy"
            _write(rules.sparkSession, path, file.getvalue())
            context.addFile(path)
        return name

    for host, path, verdict in good.toLocalIterator():
        own.append((host, path, verdict))
        size += len(host) + len(path) + 32
        if size >= block_bytes:
            yield ship()
            own, size, made = [], 0, made + 1
    if own or not made:
        yield ship()


def judge(pages: DataFrame, rules: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Host, path, rule and verdict of each page's url."""
    out = pages.select(F.col("page_id").cast("long").alias("page_id"), "url")
    passes = list(_blocks(rules, block_bytes))
    for number, name in enumerate(passes):
        last = number == len(passes) - 1

        def search(batches, name=name, first=number == 0, last=last):
            block = _mapped(name)
            for batch in batches:
                urls = batch.column("url").to_pylist()
                split = [parts_of(url) for url in urls]
                best = probe(split, block)
                if not first:
                    before = batch.column("best").to_pylist()
                    best = [_longer(tuple(b) if b else None, a) for a, b in zip(best, before, strict=True)]
                if last:
                    columns = [
                        batch.column("page_id"),
                        pa.array([h for h, _ in split], pa.string()),
                        pa.array([p for _, p in split], pa.string()),
                        pa.array([b and b[0] + b[1] for b in best], pa.string()),
                        pa.array([b[2] if b else "allow" for b in best], pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, NAMES)
                else:
                    columns = [
                        batch.column("page_id"),
                        batch.column("url"),
                        pa.array([b and list(b) for b in best], pa.list_(pa.string())),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "best"])

        out = out.mapInArrow(search, RESULT if last else "page_id long, url string, best array<string>")
    return out
