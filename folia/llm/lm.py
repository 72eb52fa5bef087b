"""Language model scores: a gated recurrent network over factored word classes, on top of
exact counts of all training documents.

1. Texts are tokenized (A-Z lower-cased; words, then one end). Every block of documents (of
   BLOCK_ROWS at most, fewer of long ones, so that a block has some BLOCK_BYTES) sends its distinct words once, with their training counts; the
   task that holds a word replies to all blocks that asked. No vocabulary is
   collected, broadcast or held by one task.
2. With the replies, each block scores the base model and turns its tokens into places
   in the network's vocabulary: the most frequent words, else a level (how often the word
   occurs, by powers of two; seen once or never is the first level). The vocabulary grows with
   the square root of the number of distinct words (`vocabulary`), as classes keep a
   step's cost near that of its square root.
3. The network is trained by truncated backpropagation on all training documents, each in
   one of `rounds` (by hash), by TRAINERS tasks side by side or as many more as there are
   TRAINER_TOKENS in a round. A task has the documents of one trainer, in the order of their ids,
   so a repeated task learns the same weights. They are averaged after each round.
4. Every whole document is scored, the state carried from window to window.

Words of one level have a share of it by their count. On the first level, words seen
once stand for those never seen: the probability that a word of this level is new is
estimated as N1 / (N1 + N2), of the tokens seen once and twice; all new words are one
symbol, as in the base model.

Defined results: a null or empty text is the one end. Each input row gives one row. A null
id is held out of training. Without training documents all counts are 0 and the model's
score is that of the first level alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from folia.llm import gru
from folia.llm.bytesops import U64, Texts, chunks, pack
from folia.llm.common import located, map_arrow, partitions, remainder, written

BLOCK_ROWS, BLOCK_BYTES = 8192, 1 << 27
OPEN_BLOCKS = 6  # whose words a task gathers at a time
GROUP_TOKENS = 1 << 21  # tokens that a trainer has in memory
SCORE_TOKENS = 1 << 22
FEWEST_WORDS, MOST_WORDS = 768, 60_000  # frequent words; a place must fit 16 bits
TRAINERS, TRAINER_TOKENS = 16, 1 << 21
FIXED = 2.0**30  # weights are summed as whole parts of one, in whatever order they come
LEVELS = 40
END_WORD = U64(0x5EED0F7E57E2D01D)
LONG = pa.int64()
ASKED = pa.schema([("word", LONG), ("block", LONG), ("n", LONG)])
# kind 0: reply; 1: of a level, the words (c) and tokens (n); 2: a frequent word.
REPLIES = pa.schema([("kind", LONG), ("block", LONG), ("word", LONG), ("c", LONG), ("n", LONG)])
TEXTS = pa.schema([("block", LONG), ("doc_id", LONG), ("held_out", pa.bool_()), ("packed", pa.binary())])
CODED = pa.schema(
    [("doc_id", LONG), ("held_out", pa.bool_()), ("n_tokens", LONG), ("n_known", LONG), ("base_score", pa.float64()), ("within", pa.float64()), ("ids", pa.binary()), ("part", LONG)]
)
RESULT = pa.schema(
    [("doc_id", LONG), ("held_out", pa.bool_()), ("n_tokens", LONG), ("n_known", LONG), ("train_tokens", LONG), ("base_score", pa.float64()), ("score", pa.float64())]
)
WEIGHTS = pa.schema([("team", LONG), ("name", pa.string()), ("n", LONG), ("value", pa.binary())])


def tokens(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of each text's words and its end, and offsets by text."""
    low = t.lowered()
    starts, ends, offsets = low.word_spans
    places = offsets + np.arange(t.size + 1)
    out = np.full(places[-1], END_WORD, U64)
    inside = np.ones(len(out), bool)
    inside[places[1:] - 1] = False
    out[inside] = low.hashes(starts, ends)
    return out, places


def levels_of(c: np.ndarray) -> np.ndarray:
    """0 for words seen at most once, then by powers of two."""
    return np.where(c <= 1, 0, np.floor(np.log2(np.maximum(c, 1))).astype(np.int64))


def _asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each block with their counts in training documents."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

    def emit(block: int, parts: list) -> pa.RecordBatch:
        words = np.concatenate([w for w, _ in parts])
        distinct, inverse = np.unique(words, return_inverse=True)
        n = np.bincount(inverse, np.concatenate([k for _, k in parts]), len(distinct)).astype(np.int64)
        return pack({"word": distinct.view(np.int64), "block": np.full(len(distinct), block), "n": n}, ASKED)

    for batch in batches:
        block, out = batch.column("block").to_numpy(), batch.column("held_out").to_numpy(zero_copy_only=False)
        for t in chunks(batch.column("text")):
            words, places = tokens(t)
            learns = np.repeat(~out[t.first : t.last], np.diff(places))
            of = np.repeat(block[t.first : t.last], np.diff(places))
            for b in np.unique(block[t.first : t.last]):
                own = of == b
                distinct, inverse = np.unique(words[own], return_inverse=True)
                held.setdefault(int(b), []).append((distinct, np.bincount(inverse, learns[own], len(distinct))))
        # Blocks go on over several batches, those of like sizes side by side.
        while len(held) > OPEN_BLOCKS:
            b = next(iter(held))
            yield emit(b, held.pop(b))
    for b, parts in held.items():
        yield emit(b, parts)


def vocabulary(distinct: float) -> int:
    """How many frequent words the network tells apart, of so many distinct ones."""
    return int(min(max(FEWEST_WORDS, distinct**0.5), MOST_WORDS))


def _replying(parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Total counts for all that asked, in a partition that has all rows of its words."""
        columns = [[c.to_numpy() for c in b.columns] for b in batches]
        if not columns:
            return
        word, block, n = (np.concatenate(x) for x in zip(*columns, strict=True))
        distinct, inverse = np.unique(word, return_inverse=True)
        total = np.bincount(inverse, n, len(distinct)).astype(np.int64)
        zero = np.zeros(len(word), np.int64)
        step = 200_000
        for a in range(0, len(word), step):
            own = slice(a, a + step)
            yield pack({"kind": zero[own], "block": block[own], "word": word[own], "c": total[inverse[own]], "n": zero[own]}, REPLIES)
        seen = total > 0
        level = levels_of(total)
        size = np.bincount(level[seen], minlength=LEVELS)
        mass = np.bincount(level[seen], total[seen], LEVELS).astype(np.int64)
        yield pack({"kind": np.ones(LEVELS, np.int64), "block": np.full(LEVELS, -1), "word": np.arange(LEVELS), "c": size, "n": mass}, REPLIES)
        # Words are dealt out by hash, so all partitions have about as many; half as many more are sent.
        best = np.argsort(-total, kind="stable")[: vocabulary(2.25 * parts * len(distinct))]
        best = best[total[best] > 1]
        yield pack({"kind": np.full(len(best), 2), "block": np.full(len(best), -1), "word": distinct[best], "c": total[best], "n": total[best]}, REPLIES)

    return run


def _packing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        texts = [squeeze((x or "").encode()) for x in batch.column("text").to_pylist()]
        yield pack({"block": batch.column("block"), "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "packed": texts}, TEXTS)


def _coding(head: np.ndarray, head_counts: np.ndarray, level_words: np.ndarray, level_mass: np.ndarray, all_tokens: int, all_words: int):
    """Scores of the base model and places in the network's vocabulary, block by block."""
    order = np.argsort(head)
    ordered = head[order]
    new_share = level_mass[0] / max(level_mass[0] + 2 * _twos(level_words, level_mass), 1)
    floor = all_tokens + 0.1 * (all_words + 1)

    def run(key, docs: pa.Table, replies: pa.Table) -> pa.Table:
        word, c = replies.column("word").to_numpy(), replies.column("c").to_numpy()
        sort = np.argsort(word)
        word, c = word[sort], c[sort]
        unpack = zstandard.ZstdDecompressor().decompress
        texts = pa.array([unpack(x).decode() for x in docs.column("packed").to_pylist()], pa.string())
        out: dict[str, list] = {k: [] for k in ("n_tokens", "n_known", "base_score", "within", "ids")}
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for t in chunks(texts):
            mine, places = tokens(t)
            mine = mine.view(np.int64)
            count = c[np.searchsorted(word, mine)]
            base = np.log10((count + 0.1) / floor)
            level = levels_of(count)
            at = np.minimum(np.searchsorted(ordered, mine), max(len(ordered) - 1, 0))
            is_head = ordered[at] == mine if len(ordered) else np.zeros(len(mine), bool)
            ids = np.where(is_head, order[at] if len(order) else 0, len(head) + level).astype(np.uint16)
            share = np.where(level > 0, count / np.maximum(level_mass[level], 1), (1 - new_share) / max(level_words[0], 1))
            share = np.where(count == 0, new_share if level_words[0] else 1.0, share)
            inner = np.where(is_head, 0.0, np.log10(np.maximum(share, 1e-300)))
            edges = places[:-1]
            out["n_tokens"] += np.diff(places).tolist()
            out["n_known"] += np.add.reduceat((count > 0).astype(np.int64), edges).tolist()
            out["base_score"] += np.add.reduceat(base, edges).tolist()
            out["within"] += np.add.reduceat(inner, edges).tolist()
            out["ids"] += [squeeze(ids[a:b].tobytes()) for a, b in zip(places[:-1], places[1:], strict=True)]
        columns = out | {"doc_id": docs.column("doc_id").combine_chunks(), "held_out": docs.column("held_out").combine_chunks(), "part": [key[0].as_py()] * docs.num_rows}
        return pa.Table.from_batches([pack(columns, CODED)])

    return run


def _twos(level_words: np.ndarray, level_mass: np.ndarray) -> int:
    """Words seen twice: level 1 holds those of two and three."""
    return max(int(3 * level_words[1] - level_mass[1]), 0)


def _ids(raw: list[bytes]) -> list[np.ndarray]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [np.frombuffer(unpack(x), np.uint16).astype(np.int32) for x in raw]


def _summing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of all weights of a partition, by name."""
    total: dict[str, tuple[int, np.ndarray]] = {}
    for batch in batches:
        for name, n, value in zip(*(batch.column(c).to_pylist() for c in ("name", "n", "value")), strict=True):
            own = np.frombuffer(value, np.int64)
            m, before = total.get(name, (0, np.zeros(len(own), np.int64)))
            total[name] = m + n, before + own
    if total:
        yield pack({"team": np.zeros(len(total), np.int64), "name": list(total), "n": [n for n, _ in total.values()], "value": [v.tobytes() for _, v in total.values()]}, WEIGHTS)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows of a batch with SCORE_TOKENS tokens together, or one longer text."""
    ends, a = np.cumsum(batch.column("n_tokens").to_numpy()), 0
    while a < batch.num_rows:
        before = ends[a - 1] if a else 0
        b = max(int(np.searchsorted(ends, before + SCORE_TOKENS, "right")), a + 1)
        yield batch.slice(a, b - a)
        a = b


def train(coded: DataFrame, first: gru.Params, n_words: int, all_tokens: int, rounds: int) -> gru.Params:
    """Rounds of training by tasks side by side; every training document is in one round
    and one task's part of it."""
    params = first
    trainers = max(TRAINERS, -(-all_tokens // (rounds * TRAINER_TOKENS)))
    pool = coded.filter("NOT held_out").withColumn("draw", F.pmod(F.xxhash64("doc_id"), F.lit(rounds)))
    for turn in range(rounds):
        trainer = F.pmod(F.xxhash64("doc_id", F.lit(turn)), F.lit(trainers)).cast("int").alias("trainer")
        own = pool.filter(F.col("draw") == turn).select(trainer, "doc_id", "ids")

        def run(batches: Iterator[pa.RecordBatch], params=params) -> Iterator[pa.RecordBatch]:
            weights, moments, k, held, size = params, {}, None, [], 0
            for batch in batches:
                for raw in batch.column("ids").to_pylist():
                    held += _ids([raw])
                    size += len(held[-1])
                    if size >= GROUP_TOKENS:
                        weights, held, size = gru.train(weights, held, n_words, moments), [], 0
                k = batch.column("trainer")[0].as_py() if batch.num_rows else k
            if k is not None:
                weights = gru.train(weights, held, n_words, moments)
                value = [np.rint(v * FIXED).astype(np.int64).tobytes() for v in map(np.float64, weights.values())]
                yield pack({"team": [k % TRAINERS] * len(weights), "name": list(weights), "n": [1] * len(weights), "value": value}, WEIGHTS)

        dealt = own.repartitionById(trainers, "trainer").sortWithinPartitions("doc_id", "ids")
        taught = map_arrow(dealt, run, WEIGHTS)
        rows = map_arrow(taught.repartition(TRAINERS, "team"), _summing, WEIGHTS).collect()  # at most TRAINERS sets
        if rows:
            n = {k: sum(r.n for r in rows if r["name"] == k) for k in params}
            params = {k: (sum(np.frombuffer(bytes(r.value), np.int64) for r in rows if r["name"] == k) / (n[k] * FIXED)).astype(v.dtype).reshape(v.shape) for k, v in params.items()}
    return params


def _blocks() -> F.Column:
    """Documents that lie together in the input and are of like size are a block: a word they
    share is asked for once, and a block of longer ones has fewer."""
    most = BLOCK_BYTES // BLOCK_ROWS
    size = F.coalesce(F.octet_length("text"), F.lit(0)) / most
    step = F.greatest(F.ceil(F.log2(F.greatest(size, F.lit(1)))), F.lit(0)).cast("int")
    rows = F.greatest(F.lit(BLOCK_ROWS) / F.pow(F.lit(2.0), step), F.lit(1.0))
    return F.xxhash64("file", step, F.floor(F.col("row") / rows))


def language_model(docs: DataFrame, rounds: int = 2) -> DataFrame:
    """Base score and model score of every document."""
    spark = docs.sparkSession
    own = (F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    blocked = located(docs, *own).withColumn("block", _blocks())
    blocked = blocked.withColumn("held_out", F.coalesce(remainder(10) == 0, F.lit(True)))

    parts = partitions(spark)
    asked = map_arrow(blocked, _asking, ASKED).repartition(parts, "word")
    replies = written(map_arrow(asked, _replying(parts), REPLIES), "replies")
    by_level = {r.word: (r.c, r.n) for r in replies.filter("kind = 1").groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect()}  # LEVELS rows
    words, mass = (np.array([by_level.get(k, (0, 0))[i] for k in range(LEVELS)], np.int64) for i in range(2))
    all_words, all_tokens = int(words.sum()), int(mass.sum())
    frequent = replies.filter("kind = 2").orderBy(F.desc("c"), "word").limit(vocabulary(all_words)).collect()
    head, head_counts = np.array([r.word for r in frequent], np.int64), np.array([r.c for r in frequent], np.int64)
    for level in levels_of(head_counts):
        words[level] -= 1
    np.subtract.at(mass, levels_of(head_counts), head_counts)

    packed = map_arrow(blocked, _packing, TEXTS)
    own = replies.filter("kind = 0").select("block", "word", "c")
    coding = _coding(head, head_counts, words, mass, all_tokens, all_words)
    coded = written(packed.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(coding, from_arrow_schema(CODED)), "coded")
    levels = mass[: int(np.flatnonzero(mass).max(initial=0)) + 1]
    params = train(coded, gru.start(head_counts.astype(float), levels.astype(float)), len(head), all_tokens, rounds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                ids = _ids(part.column("ids").to_pylist())
                offsets = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
                states = gru.score(params, np.concatenate(ids), offsets, len(head)) / np.log(10)
                yield pack(
                    {c: part.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base_score")}
                    | {"train_tokens": np.full(part.num_rows, all_tokens), "score": states + part.column("within").to_numpy()},
                    RESULT,
                )

    return map_arrow(coded, run, RESULT)
