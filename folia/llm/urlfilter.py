"""URL filters: a trie over reversed host labels, then path segments; the longest match decides.

A rule is a host, a path and a verdict. It fits its host and all hosts below it, if the URL's
path starts with the rule's. The trie is walked label by label from the end of the host; every
node on the way may hold paths, and these are walked segment by segment. The last piece of a
rule's path need not be a whole segment, so each node also holds such pieces. Of all rules met
the longest wins (host and path together; then the longer host; then "block"), whatever its
verdict; URLs that no rule fits get the `default`.

The trie is broadcast. Rules are first measured: those of more than `block_bytes` are split
by a hash of the rule into blocks below that size, each with a trie of its own. The URLs then
pass by one trie after another, and the longest match of all is kept.

Defined results: a null URL, or one without `://`, has an empty host and path. An empty host fits
only rules with an empty host, which fit all. Null fields of a rule count as empty; the host's A-Z are
lower-cased in rules as in URLs, and nothing else is changed: a port, user or
final dot is part of the host. Rules that are there twice count once; one that is both
allowed and blocked blocks. Every row of the table gives one, repeated ids included; a rule-less
list gives the default to all. Columns other than the two named are never read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folia.llm.common import map_arrow

ALLOW, BLOCK = "allow", "block"
BLOCK_BYTES = 8 << 20  # text of the rules in one trie
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
JUDGED = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("verdict", pa.string()), ("length", pa.int64())])


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host, A-Z lower-cased, and the path of a URL."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, k), F.lit("")) for k in (1, 2))
    return F.translate(host, UPPER, LOWER), path


def length_of(host: str, path: str, verdict: str) -> int:
    """Order of precedence as one number."""
    return (len(host) + len(path) << 32) + (len(host) << 1) + (verdict == BLOCK)


class Trie:
    """Nodes are numbers; 0 is the root. Host labels and path segments lead from node to node."""

    def __init__(self, rules: list[tuple[str, str, str]]):
        self.labels: dict[tuple[int, str], int] = {}
        self.segments: dict[tuple[int, str], int] = {}
        self.pieces: dict[int, dict[str, tuple[int, str, str]]] = {}
        self.nodes = 1
        for host, path, verdict in rules:
            node = 0
            for label in reversed(host.split(".")) if host else ():
                node = self._step(self.labels, node, label)
            *whole, piece = path.split("/")
            for segment in whole:
                node = self._step(self.segments, node, segment)
            own = (length_of(host, path, verdict), host + path, verdict)
            held = self.pieces.setdefault(node, {})
            held[piece] = max(own, held.get(piece, own))
        self.sizes = {node: sorted({len(p) for p in held}) for node, held in self.pieces.items()}

    def _step(self, edges: dict[tuple[int, str], int], node: int, token: str) -> int:
        found = edges.get((node, token))
        if found is None:
            found = edges[node, token] = self.nodes
            self.nodes += 1
        return found

    def match(self, host: str, path: str) -> tuple[int, str, str] | None:
        """The longest rule that fits: its order, text and verdict."""
        best, parts, node = None, path.split("/"), 0
        labels = iter(reversed(host.split("."))) if host else iter(())
        while True:
            below = node
            for k, part in enumerate(parts):
                for size in self.sizes.get(below, ()):
                    own = self.pieces[below].get(part[:size]) if size <= len(part) else None
                    if own is not None and (best is None or own > best):
                        best = own
                # Only a segment with a slash behind it is whole.
                below = self.segments.get((below, part)) if k + 1 < len(parts) else None
                if below is None:
                    break
            label = next(labels, None)
            following = None if label is None else self.labels.get((node, label))
            if following is None:
                return best
            node = following


def _judging(trie: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        match = trie.value.match
        for batch in batches:
            hosts, paths = batch.column("host").to_pylist(), batch.column("path").to_pylist()
            rule, verdict, length = (batch.column(c).to_pylist() for c in ("rule", "verdict", "length"))
            for k, (host, path) in enumerate(zip(hosts, paths, strict=True)):
                own = match(host, path)
                if own is not None and own[0] > length[k]:
                    length[k], rule[k], verdict[k] = own
            columns = [batch.column("page_id"), batch.column("host"), batch.column("path"), *(pa.array(x, f.type) for x, f in zip((rule, verdict, np.array(length)), list(JUDGED)[3:], strict=True))]
            yield pa.RecordBatch.from_arrays(columns, schema=JUDGED)

    return run


def url_filter(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", *, default: str = ALLOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per page: page_id, host, path, the rule that decides (null if none) and the
    verdict. `rules` has host, path and verdict."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col))
    judged = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path")).withColumns(
        {"rule": F.lit(None).cast("string"), "verdict": F.lit(default), "length": F.lit(-1).cast("long")}
    )
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("host", "path", "verdict")]
    plain = rules.select(*fields).withColumn("host", F.translate("host", UPPER, LOWER)).distinct()
    size = plain.agg(F.coalesce(F.sum(F.octet_length("host") + F.octet_length("path") + 64), F.lit(0))).first()[0]
    blocks = -(-2 * size // block_bytes) if size > block_bytes else int(size > 0)
    number = F.pmod(F.xxhash64("host", "path"), F.lit(max(blocks, 1)))
    for k in range(blocks):
        own = plain.filter(number == k).collect()  # about half of `block_bytes`, or all rules if they are below
        trie = spark.sparkContext.broadcast(Trie([tuple(r) for r in own]))
        judged = map_arrow(judged, _judging(trie), JUDGED)
    return judged.drop("length")
