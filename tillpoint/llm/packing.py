"""Best-fit packing of token sequences by a grouping genetic algorithm on islands."""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillpoint.session import materialize

CAPACITY = 4096
#: Id that ends every document.
END_ID = 1
#: Pieces that are packed together on one island, on average.
GROUP_PIECES = 1500
ISLANDS = 2
POPULATION = 6
GENERATIONS = 8
#: Rounds of evolution; between two of them the best packing of an island moves to the next island.
EPOCHS = 2
#: Bins filled less than this share are taken apart and packed again with those of other groups.
WELL_FILLED = 0.98
#: Words whose ids a worker keeps; the others are tokenized again when they come.
CACHED_WORDS = 400_000
#: Bytes of texts that are looked up together: of a word that comes often in them the ids are looked up once.
PORTION_BYTES = 2 << 20
_MARK = "\x01"
#: An ASCII or Latin-1 letter and ASCII punctuation after it (an apostrophe may join them, so it is left out).
_JOINT = r"([a-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{ff}])([!-&(-/:-@\[-`{-~])"
#: UTF-8 of ASCII and Latin-1 letters.
_LETTERS = re.compile(rb"(?:[a-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


class WordTokenizer:
    """Ids of whole texts from a tokenizer that never joins characters across white space, nor letters and the
    punctuation after them.

    Such a tokenizer gives a text the ids of its words one after the other, so each word is tokenized once and its ids
    are kept. A word is a run without ASCII white space, cut between a letter and punctuation after it; A-Z are
    lower-cased first, as the tokenizer does itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        self.cache: dict[bytes, bytes] = {}
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        suffix, vocab = getattr(self.tokenizer.model, "end_of_word_suffix", None), self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for token, i in vocab.items() if suffix and token.endswith(suffix)]] = True

    def _learn(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of new words. Of letters alone only the last id ends a word, so many are tokenized in one call and told
        apart by their ends; all other words get marks between them."""
        known: dict[bytes, bytes] = {}
        letters, rest = [], []
        for w in words:
            (letters if _LETTERS.fullmatch(w) else rest).append(w)
        groups = [letters[i:i + 1024] for i in range(0, len(letters), 1024)]
        for g, e in zip(groups, self.tokenizer.encode_batch_fast([b" ".join(g).decode() for g in groups],
                                                                 add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            stops = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(stops) == len(g):
                ids = ids.tobytes()
                known.update(zip(g, map(ids.__getitem__, map(slice, [0] + stops, stops))))
            else:
                rest += g
        return known | self._tokenize(rest)

    def _tokenize(self, words: list[bytes]) -> dict[bytes, bytes]:
        """Ids of words, many in one call: a lone mark between two words shows where one ends."""
        known: dict[bytes, bytes] = {}
        plain, odd = [], []
        for w in words:
            (odd if _MARK.encode() in w or len(self.mark) != 1 else plain).append(w)
        groups = [plain[i:i + 64] for i in range(0, len(plain), 64)]
        found = self.tokenizer.encode_batch_fast(
            [f" {_MARK} ".join(w.decode("utf-8", "replace") for w in g) for g in groups], add_special_tokens=False)
        for g, e in zip(groups, found):
            parts: list[list[int]] = [[]]
            for i in e.ids:
                parts.append([]) if i == self.mark[0] else parts[-1].append(i)
            if len(parts) == len(g):
                known |= {w: array("I", p).tobytes() for w, p in zip(g, parts)}
            else:
                odd += g
        for w in odd:
            ids = self.tokenizer.encode(w.decode("utf-8", "replace"), add_special_tokens=False).ids
            known[w] = array("I", ids).tobytes()
        return known

    def encode(self, texts: pa.Array) -> list[memoryview]:
        """Little-endian unsigned 32-bit ids of every text."""
        lower = pc.ascii_lower(texts.cast(pa.large_string()))
        split = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, pattern=_JOINT, replacement=r"\1 \2"))
        coded = split.values.dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.cache.get, words))
        new = self._learn([w for w, i in zip(words, ids) if i is None])
        if new:
            ids = [new[w] if i is None else i for w, i in zip(words, ids)]
            self.cache.update(islice(new.items(), max(0, CACHED_WORDS - len(self.cache))))
        _, at, data = pa.array(ids, pa.large_binary()).take(coded.indices).buffers()
        at = np.frombuffer(at, np.int64)[split.offsets.to_numpy()].tolist()
        data = memoryview(data or b"")
        return [data[a:b] for a, b in zip(at, at[1:])]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str | None) -> WordTokenizer:
    """The tokenizer of this worker; without a path, the installed 49k-word vocabulary."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _portions(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes; a batch goes beyond it by 15 rows at most."""
    held: list[pa.RecordBatch] = []
    filled = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 16):
            held.append(batch.slice(at, 16))
            filled += held[-1].nbytes
            if filled >= size:
                yield pa.concat_batches(held)
                held, filled = [], 0
    if held:
        yield pa.concat_batches(held)


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 tokenizer_path: str | None = None) -> DataFrame:
    """(uid, id, piece, start, length, ids_crc32): each document's ids and an end id, cut at every ``capacity`` ids."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, uid = tokenizer(tokenizer_path), TaskContext.get().partitionId() << 33
        end = array("I", [END_ID]).tobytes()
        for batch in _portions(batches, PORTION_BYTES):
            rows = []
            for row, ids in enumerate(tok.encode(batch.column("t"))):
                n = len(ids) // 4 + 1
                for p, start in enumerate(range(0, n, capacity)):
                    length, crc = min(capacity, n - start), zlib.crc32(ids[4 * start:4 * (start + capacity)])
                    if start + length == n:
                        crc = zlib.crc32(end, crc)
                    rows.append((uid, row, p, start, length, crc))
                    uid += 1
            made = np.array(rows, np.int64).reshape(-1, 6).T
            number = [pa.array(c) for c in made]
            yield pa.RecordBatch.from_arrays(
                [number[0], batch.column("id").take(number[1]), number[2].cast(pa.int32()), *number[3:]],
                names=["uid", "id", "piece", "start", "length", "ids_crc32"])
        pa.default_memory_pool().release_unused()  # the worker lives on

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
            .mapInArrow(cut, f"uid long, id {kind}, piece int, start long, length long, ids_crc32 long"))


class Packing:
    """Bins of item numbers with their fill; items are put where the least room remains."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []

    def copy_bin(self, items: list[int]) -> None:
        self.bins.append(list(items))
        self.room.append(self.capacity - sum(map(self.lengths.__getitem__, items)))

    def best_fit(self, items: list[int]) -> Packing:
        order = sorted((r, b) for b, r in enumerate(self.room) if r)
        for i in items:
            n = self.lengths[i]
            at = bisect_left(order, (n, -1))
            if at == len(order):
                self.bins.append([])
                self.room.append(self.capacity)
                r, b = self.capacity, len(self.bins) - 1
            else:
                r, b = order.pop(at)
            self.bins[b].append(i)
            self.room[b] = r - n
            if r > n:
                insort(order, (r - n, b))
        return self

    def fitness(self) -> tuple[int, float]:
        """Fewer bins first, then the more uneven fill, which leaves one bin to empty."""
        return -len(self.bins), sum((self.capacity - r) ** 2 for r in self.room)

    def numbers(self) -> list[int]:
        out = [0] * len(self.lengths)
        for b, items in enumerate(self.bins):
            for i in items:
                out[i] = b
        return out


def from_numbers(lengths: list[int], capacity: int, numbers) -> Packing:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(numbers):
        bins.setdefault(int(b), []).append(i)
    out = Packing(lengths, capacity)
    for items in bins.values():
        out.copy_bin(items)
    return out


def crossover(a: Packing, b: Packing, rng: np.random.Generator) -> Packing:
    """Inject well-filled bins of ``b`` into ``a``: bins of ``a`` that share an item with them go, and the items this
    displaces are put back by best fit, longest first."""
    order = sorted(range(len(b.bins)), key=lambda k: b.room[k])[:max(1, len(b.bins) // 2)]
    chosen = [k for k in order if rng.random() < 0.5] or order[:1]
    child = Packing(a.lengths, a.capacity)
    taken: set[int] = set()
    for k in chosen:
        child.copy_bin(b.bins[k])
        taken.update(b.bins[k])
    displaced = []
    for items in a.bins:
        if taken.isdisjoint(items):
            child.copy_bin(items)
        else:
            displaced += [i for i in items if i not in taken]
    return child.best_fit(sorted(displaced, key=lambda i: -a.lengths[i]))


def mutate(a: Packing, rng: np.random.Generator) -> Packing:
    """Take the emptiest bin and a few others apart and put their items back by best fit."""
    gone = {int(np.argmax(a.room)), *rng.integers(0, len(a.bins), 3).tolist()}
    out = Packing(a.lengths, a.capacity)
    for k, items in enumerate(a.bins):
        if k not in gone:
            out.copy_bin(items)
    return out.best_fit(sorted((i for k in gone for i in a.bins[k]),
                               key=lambda i: -a.lengths[i] * (0.8 + 0.4 * rng.random())))


def evolve(lengths: list[int], capacity: int, population: list[Packing], seed: int) -> list[Packing]:
    """One epoch of an island; ends early when no packing can have fewer bins."""
    rng = np.random.default_rng(seed)
    least = -(-sum(lengths) // capacity)
    longest_first = sorted(range(len(lengths)), key=lambda i: -lengths[i])
    if not population:
        population = [Packing(lengths, capacity).best_fit(longest_first)]
    while len(population) < POPULATION and max(p.fitness() for p in population)[0] < -least:
        noise = rng.uniform(0.7, 1.3, len(lengths))
        population.append(Packing(lengths, capacity).best_fit(sorted(longest_first, key=lambda i: -lengths[i] * noise[i])))
    for _ in range(GENERATIONS):
        population.sort(key=Packing.fitness, reverse=True)
        population = population[:POPULATION]
        if -population[0].fitness()[0] == least or len(population) < 2:
            break
        for k in range(POPULATION // 2):
            a, b = rng.choice(len(population), 2, replace=False)
            population.append(crossover(population[min(a, b)], population[max(a, b)], rng))
            population.append(mutate(population[k % len(population)], rng))
    return sorted(population, key=Packing.fitness, reverse=True)[:POPULATION]


_STATE = "grp long, island int, uids array<long>, lengths array<long>, pop array<array<int>>, bins int, fill double"


def _islands(capacity: int, epoch: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for r in pdf.itertuples():
                lengths = [int(x) for x in r.lengths]
                start = [from_numbers(lengths, capacity, p) for p in (r.pop if r.pop is not None else [])]
                seed = [abs(int(r.grp)), int(r.island), epoch]
                best = evolve(lengths, capacity, start, seed)[:2]
                n, fill = best[0].fitness()
                rows.append((r.grp, r.island, r.uids, r.lengths, [p.numbers() for p in best], -n, fill))
            yield pd.DataFrame(rows, columns=["grp", "island", "uids", "lengths", "pop", "bins", "fill"])
    return run


def _place(capacity: int, level: int, last: bool):
    """Bin and offset of every piece; pieces of badly filled bins get none, to be packed again."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for r in pdf.itertuples():
                numbers, lengths = np.asarray(r.numbers, np.int64), np.asarray(r.lengths, np.int64)
                fill = np.bincount(numbers, weights=lengths)
                order = np.lexsort((r.uids, numbers))
                before = np.cumsum(lengths[order]) - lengths[order]
                first = np.r_[True, numbers[order][1:] != numbers[order][:-1]]
                offset = before - np.maximum.accumulate(np.where(first, before, 0))
                again = (fill[numbers[order]] < WELL_FILLED * capacity) & (not last)
                yield pd.DataFrame({"uid": np.asarray(r.uids)[order], "length": lengths[order],
                                    "sequence_id": (level << 56) + (int(r.grp) << 16) + numbers[order],
                                    "offset": offset, "again": again})
    return run


def _pack_groups(pieces: DataFrame, n: int, capacity: int, level: int, last: bool) -> DataFrame:
    """Pack (uid, length) in groups dealt by hash; every group evolves on its islands."""
    groups = -(-n // GROUP_PIECES)
    dealt = (pieces.groupBy(F.pmod(F.xxhash64(F.lit(level), "uid"), F.lit(groups)).alias("grp"))
             .agg(F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("items"))
             .select("grp", F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                     F.col("items.uid").alias("uids"), F.col("items.length").alias("lengths"),
                     F.lit(None).cast("array<array<int>>").alias("pop"), F.lit(0).alias("bins"),
                     F.lit(0.0).alias("fill")))
    state = dealt.repartition(max(1, min(groups * ISLANDS, 2 * int(
        pieces.sparkSession.conf.get("spark.sql.shuffle.partitions")))), "grp", "island")
    for epoch in range(EPOCHS):
        if epoch:  # elite migration: the best packing of an island joins the population of the next one
            elite = state.select(F.col("grp").alias("e_grp"), ((F.col("island") + 1) % ISLANDS).alias("e_island"),
                                 F.get("pop", F.lit(0)).alias("elite"))
            state = (state.join(elite, (F.col("grp") == F.col("e_grp")) & (F.col("island") == F.col("e_island")))
                     .select("grp", "island", "uids", "lengths", F.concat("pop", F.array("elite")).alias("pop"),
                             "bins", "fill"))
        state = materialize(state.mapInPandas(_islands(capacity, epoch), _STATE), f"islands-{level}-{epoch}")
    best = (state.groupBy("grp").agg(F.max_by(F.struct("uids", "lengths", F.get("pop", F.lit(0)).alias("numbers")),
                                              F.struct(-F.col("bins"), "fill", -F.col("island"))).alias("b"))
            .select("grp", "b.uids", "b.lengths", "b.numbers"))
    return best.mapInPandas(_place(capacity, level, last),
                            "uid long, length long, sequence_id long, offset long, again boolean")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
         tokenizer_path: str | None = None, max_levels: int = 6) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` tokens; one row per piece.

    Full pieces are a sequence each. The others are dealt by hash into groups of about ``GROUP_PIECES``; each group is
    evolved on ``ISLANDS`` islands whose best packings migrate between epochs, and the best of all is taken. Pieces of
    bins that stay badly filled are pooled over all groups and packed again, level by level, until one group is left; so
    the waste does not grow with the number of groups. Lists of one group are the largest thing a task holds.

    Defined cases: a null text is an empty one, whose only id is the end id; repeated rows are all packed; null ids are
    packed like others; an empty table gives none; further columns are ignored.
    """
    pieces = materialize(token_pieces(docs, id_col, text_col, capacity, tokenizer_path), "pieces")
    full = F.col("length") == capacity
    placed = pieces.where(full).select("uid", (F.lit(1 << 60) + F.col("uid")).alias("sequence_id"),
                                       F.lit(0).cast("long").alias("offset"))
    rest = pieces.where(~full).select("uid", "length")
    n = rest.count()
    for level in range(1, max_levels + 1):
        if not n:
            break
        last = n <= GROUP_PIECES or level == max_levels
        out = materialize(_pack_groups(rest, n, capacity, level, last), f"packed-{level}")
        placed = placed.unionByName(out.where(~F.col("again")).select("uid", "sequence_id", "offset"))
        rest = out.where("again").select("uid", "length")
        before, n = n, rest.count()
        if n == before:  # nothing fits better together: keep the packing as it is
            placed = placed.unionByName(out.where("again").select("uid", "sequence_id", "offset"))
            break
    return (pieces.join(placed.withColumnRenamed("uid", "p_uid"), F.col("uid") == F.col("p_uid"))
            .select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset"))
