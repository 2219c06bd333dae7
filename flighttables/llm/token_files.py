"""Token-id files compressed by Re-Pair grammars.

Documents are dealt by ranges of their id and encoded in id order; every run of about ``shard_tokens`` ids
becomes a shard.  A shard's ids are compressed by rounds of Re-Pair: each round counts the adjacent pairs,
makes the frequent ones nonterminals and replaces their occurrences (of overlapping ones the more frequent
pair's), until no pair is frequent.  A document always begins with a symbol of its own.

The file format is a Parquet table with one row per shard, written under the shared folder:

=============  ==============================================================================
part, shard    place of the shard: range partition, number within it
start          ids in the part before this shard
doc_ids        ids of the documents, ascending
doc_lengths    uint32 per document: its token ids
rules          uint32 pairs: nonterminal ``base + i`` stands for symbols ``rules[i]``
rule_lengths   uint32 per rule: token ids it expands to (what random access needs)
symbols        uint32: the compressed sequence
=============  ==============================================================================
"""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flighttables.llm._common import blocks, in_arrow, new_output_dir, starts_of

END_ID = 1
_SLOT_BITS = 16


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import json
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    parts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [spec.get("pre_tokenizer") or {}]
    # Spaces separate for certain where the pattern drops them and no added token holds or takes in a space.
    apart = any(p.get("type") == "Split" and p.get("behavior") == "Removed" and p.get("invert")
                and r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in str((p.get("pattern") or {}).get("Regex")) for p in parts)
    apart &= not any(a["lstrip"] or a["rstrip"] or a["single_word"] or set(a["content"]) & set(" .,") or a["content"] != a["content"].lower()
                     for a in spec.get("added_tokens", []))
    steps = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
    lowers = "Lowercase" in steps
    # Then a word of lower-case Latin letters goes to the library's model as it is, in the alphabet of bytes.
    plain = apart and set(steps) <= {"NFC", "Replace", "Lowercase"} and [p.get("type") for p in parts] == ["Split", "ByteLevel"] \
        and not parts[-1].get("add_prefix_space") and not any(a["content"].isalpha() for a in spec.get("added_tokens", []))
    return tok, apart, lowers, plain


def _byte_alphabet() -> dict[int, int]:
    """The printable character of each byte in byte-level vocabularies: itself, or the next one from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {**{b: b for b in shown}, **{b: 256 + i for i, b in enumerate(rest)}}


_ALPHABET = _byte_alphabet()


_ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
_SPACE = np.array([c in b"\x20\x09\x0a\x0b\x0c\x0d" for c in range(256)])


def part_stops(texts: list[bytes]) -> list[bytes]:
    """The texts with a space put before each full stop or comma that ends a word after an ASCII letter or digit: the
    pattern makes such a stop a part of its own anyway."""
    whole = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    at = np.flatnonzero((whole == 46) | (whole == 44))
    at = at[_ALNUM[whole[at - 1]] & _SPACE[whole[at + 1]]]
    out = np.insert(whole, at, 32).tobytes()
    begin = 1 + starts_of(np.array([len(t) + 1 for t in texts], np.int64))
    end = begin + np.array([len(t) for t in texts], np.int64)
    return [out[s:e] for s, e in zip((begin + np.searchsorted(at, begin)).tolist(), (end + np.searchsorted(at, end)).tolist())]


def _latin(word: str) -> bool:
    """Whether the word has only lower-case Latin letters (below U+0250) that normalising leaves as they are."""
    return word.isalpha() and max(word) < "\u0250" and word.lower() == word and unicodedata.is_normalized("NFC", word)


class Encoder:
    """Token ids of texts, exactly as the library gives them without special tokens.

    Where spaces separate tokens for certain, the ids of a text are those of its words in order, so each
    distinct word is encoded once by the library and kept (at most about ``limit`` words, and ``most`` bytes of words and ids, in a
    Python worker; when they are too many, those that were met again since the last time stay, at most half of the limit).
    A stop that ends a word counts as a word, and case does not tell words apart where the tokenizer
    lowers it and both forms of the text are in normal form C, which makes the order of the two steps all one.
    """

    def __init__(self, path: str, limit: int = 800_000, most: int = 48_000_000):
        self.tok, self.apart, self.lowers, self.plain = _tokenizer(path)
        self.limit, self.most = limit, most
        self._clear()

    def _clear(self):
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.begin = np.zeros(1 << 16, np.int64)
        self.size = np.zeros(1 << 16, np.int64)
        self.met = np.zeros(1 << 16, np.int64)
        self.used = self.held = 0

    def _forget(self):
        """Keep the words met again since the last time, the most frequent ones if they are many."""
        n = len(self.place)
        stay = np.flatnonzero(self.met[:n] > 1)
        if len(stay) > self.limit // 2:
            stay = np.sort(stay[np.argsort(-self.met[stay], kind="stable")[:self.limit // 2]])
        known = list(self.place)  # in the order of their numbers
        kept = list(map(known.__getitem__, stay.tolist()))
        begin, size, ids = self.begin[stay], self.size[stay], self.ids
        held = sum(map(len, kept)) + 4 * int(size.sum())
        self._clear()
        if held > self.most // 2:  # a few words take it all
            return
        self.place = dict(zip(kept, range(len(kept))))
        self.used, self.held = int(size.sum()), held
        self.ids = _room(ids[np.repeat(begin - starts_of(size), size) + np.arange(self.used)], 1 << 16)
        self.begin, self.size = _room(starts_of(size), 1 << 16), _room(size, 1 << 16)
        self.met = np.zeros(len(self.begin), np.int64)

    def _learn(self, new: list[bytes]):
        for at in range(0, len(new), 20_000):
            some, other, flat, size, tokenize = [], [], [], [], self.tok.model.tokenize
            for w in new[at:at + 20_000]:
                if self.plain and w.isalpha() and w.islower():  # a-z
                    got = tokenize(w.decode())
                elif self.plain and _latin(t := w.decode()):
                    got = tokenize(w.decode("latin-1").translate(_ALPHABET))
                else:
                    other.append(w)
                    continue
                some.append(w)
                flat += [x.id for x in got]  # no list stays for each word: many of them keep the garbage collector busy
                size.append(len(got))
            some += other
            for e in self.tok.encode_batch_fast([w.decode() for w in other], add_special_tokens=False):
                flat += e.ids
                size.append(len(e))
            flat, size = np.fromiter(flat, np.uint32, len(flat)), np.array(size, np.int64)
            n = len(self.place)
            self.ids = _room(self.ids, self.used + len(flat))
            self.begin, self.size = _room(self.begin, n + len(some)), _room(self.size, n + len(some))
            self.ids[self.used:self.used + len(flat)] = flat
            self.begin[n:n + len(some)] = self.used + starts_of(size)
            self.size[n:n + len(some)] = size
            self.used += len(flat)
            self.held += sum(map(len, some)) + 4 * len(flat)
            self.place.update(zip(some, range(n, n + len(some))))

    def _lowered(self, text: str | None) -> bytes:
        if not text:
            return b""
        raw = text.encode()
        if self.lowers:
            low = raw.lower()
            if text.isascii() or (unicodedata.is_normalized("NFC", text) and unicodedata.is_normalized("NFC", low.decode())):
                raw = low
        return raw

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, lengths)`` of the texts one after another, each closed by :data:`END_ID`."""
        if not self.apart:
            got = [self.tok.encode(t or "", add_special_tokens=False).ids + [END_ID] for t in texts]
            return np.array([i for g in got for i in g], np.uint32), np.array([len(g) for g in got], np.int64)
        tokens = [t.split() for t in part_stops([self._lowered(t) for t in texts])]
        if len(self.place) > self.limit or self.held > self.most:
            self._forget()
        flat = list(chain.from_iterable(tokens))
        at = np.fromiter(map(self.place.get, flat, repeat(-1)), np.int64, len(flat))
        missing = np.flatnonzero(at < 0).tolist()
        if missing:
            self._learn(list(dict.fromkeys(map(flat.__getitem__, missing))))
            at[missing] = list(map(self.place.__getitem__, map(flat.__getitem__, missing)))
        self.met = _room(self.met, len(self.begin))
        self.met += np.bincount(at, minlength=len(self.met))
        n_words = np.array([len(t) for t in tokens], np.int64)
        size = self.size[at]
        text_of = np.repeat(np.arange(len(texts)), n_words)
        lengths = np.bincount(text_of, size, len(texts)).astype(np.int64) + 1
        total = int(lengths.sum())
        out = np.full(total, END_ID, np.uint32)
        keep = np.ones(total, bool)
        keep[np.cumsum(lengths) - 1] = False
        out[keep] = self.ids[np.repeat(self.begin[at] - starts_of(size), size) + np.arange(total - len(texts))]
        return out, lengths


@lru_cache(maxsize=1)
def _worker_encoder(path: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    return Encoder(path)


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if len(a) >= n else np.concatenate((a, np.zeros(max(n, 2 * len(a)) - len(a), a.dtype)))


def compress(ids: np.ndarray, lengths: np.ndarray, base: int, min_count: int = 8, rounds: int | None = None,
             per_round: int = 1 << 13) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair of one shard: ``(rules, rule_lengths, symbols)``.

    ``ids`` are below ``base``; ``lengths`` are the documents' sizes.  A round replaces at most ``per_round``
    pairs, the most frequent ones first; pairs left over have their turn in a later round, until no pair occurs
    ``min_count`` times (or after ``rounds``).  Each round replaces its most frequent pair wherever it does not overlap
    itself, so the rounds end.  A pair that is not frequent cannot become so, but for those with a new symbol: a
    round counts only the places of pairs that were frequent or have a symbol of the round before.
    """
    present = np.flatnonzero(np.bincount(ids, minlength=base)) if len(ids) else np.zeros(0, np.int64)
    dense = np.zeros(base, np.int64)
    dense[present] = np.arange(len(present))
    n_dense, n_rules = len(present), 0  # symbols in use: the ids that occur, then the rules
    half, kind = 16, np.uint32  # bits of a symbol in a pair
    seq = dense[ids].astype(kind)
    last = np.zeros(len(seq), bool)
    last[np.cumsum(lengths[lengths > 0]) - 1] = True
    live = ~last  # places (left symbols) whose pair may be frequent
    rules: list[np.ndarray] = []
    sizes = [np.ones(n_dense, np.int64)]
    done = 0
    while rounds is None or done < rounds:
        done += 1
        if half == 16 and n_dense + n_rules + per_round > 1 << 16:
            half, kind = 32, np.uint64
            seq = seq.astype(kind)
        multiply, drop = (np.uint32(0x9E3779B1), kind(32 - _SLOT_BITS)) if half == 16 else (np.uint64(0x9E3779B97F4A7C15), kind(64 - _SLOT_BITS))
        place = np.flatnonzero(live)
        if not len(place):
            break
        key = (seq[place] << kind(half)) | seq[place + 1]
        found = np.sort(key)
        head = np.flatnonzero(np.concatenate(([True], found[1:] != found[:-1])))
        count = np.diff(np.append(head, len(found)))
        often = np.flatnonzero(count >= min_count)
        if not len(often):
            break
        frequent = found[head[often]]
        if len(often) > per_round:
            often = often[np.argpartition(-count[often], per_round)[:per_round]]
        often = often[np.argsort(count[often], kind="stable")]
        pairs = found[head[often]]
        # A table by hash finds the pair of every place; of pairs that share a slot the most frequent is in.
        slot = (pairs * multiply) >> drop
        holds, score = np.zeros(1 << _SLOT_BITS, kind), np.zeros(1 << _SLOT_BITS, np.int32)
        holds[slot] = pairs
        score[slot] = np.arange(1, len(pairs) + 1)  # by rising count
        at = (key * multiply) >> drop
        points = np.where(holds[at] == key, score[at], 0)
        some = np.flatnonzero(points)
        where, points = place[some], points[some]
        # A pair wins over less frequent ones that overlap it; of a pair that overlaps itself every other one is taken.
        touch = where[1:] == where[:-1] + 1
        begins = np.concatenate(([True], ~(touch & (points[1:] == points[:-1]))))
        run = np.flatnonzero(begins)
        more = np.concatenate(([True], ~touch[run[1:] - 1] | (points[run[1:]] > points[run[1:] - 1])))  # than the run before
        less = np.concatenate((~touch[run[1:] - 1] | (points[run[1:]] < points[run[1:] - 1]), [True]))  # than the run after
        of = np.cumsum(begins) - 1
        win = (more & less)[of] & ((np.arange(len(where)) - run[of]) % 2 == 0)
        take, which = where[win], points[win] - 1
        enough = np.bincount(which, minlength=len(pairs)) >= max(1, min_count // 2)
        take, which = take[enough[which]], which[enough[which]]
        used = np.flatnonzero(enough)
        number = np.zeros(len(pairs), kind)
        number[used] = n_dense + n_rules + np.arange(len(used))
        left, right = (pairs[used] >> kind(half)).astype(np.int64), (pairs[used] & kind((1 << half) - 1)).astype(np.int64)
        size = np.concatenate(sizes)
        sizes = [size, size[left] + size[right]]
        rules.append(np.stack((left, right), axis=1))
        n_rules += len(used)
        keep = np.zeros(1 << _SLOT_BITS, bool)  # by hash: a place that only shares a slot stays for nothing
        keep[(frequent * multiply) >> drop] = True
        live[place] = keep[at]
        live[take] = True
        live[take[take > 0] - 1] = True
        seq[take] = number[which]
        last[take] = last[take + 1]
        stay = np.ones(len(seq), bool)
        stay[take + 1] = False
        seq, last, live = seq[stay], last[stay], live[stay]
        live &= ~last
    symbol = np.concatenate((present, base + np.arange(n_rules)))
    size = np.concatenate(sizes)
    out = symbol[np.concatenate(rules)] if rules else np.zeros((0, 2), np.int64)
    return out.astype(np.uint32), size[n_dense:].astype(np.uint32), symbol[seq.astype(np.int64)].astype(np.uint32)


class Shard:
    """Random access to the ids of one compressed shard."""

    def __init__(self, rules: np.ndarray, rule_lengths: np.ndarray, symbols: np.ndarray, base: int):
        self.base, self.symbols = base, symbols
        self.sizes = rule_lengths.astype(np.int64)
        self.starts = starts_of(self.sizes)
        self.flat = np.zeros(int(self.sizes.sum()), np.uint32)
        n = len(rules)
        at = 0
        while at < n:  # rules that use only earlier ones are written out together
            upto = at + 1 + int(np.searchsorted(np.maximum.accumulate(rules[at + 1:].max(axis=1, initial=0)), base + at))
            some = rules[at:upto]
            ids, _ = self._expand(some.reshape(-1))
            self.flat[self.starts[at]:self.starts[at] + len(ids)] = ids
            at = upto
        self.ends = np.cumsum(self._size(symbols))

    def _size(self, symbols: np.ndarray) -> np.ndarray:
        s = symbols.astype(np.int64) - self.base
        return np.where(s < 0, 1, self.sizes[np.maximum(s, 0)]) if len(self.sizes) else np.ones(len(s), np.int64)

    def _expand(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        size = self._size(symbols)
        out = np.repeat(symbols, size)
        s = symbols.astype(np.int64) - self.base
        compound = np.repeat(s >= 0, size)
        if compound.any():
            place = np.repeat(np.where(s >= 0, self.starts[np.maximum(s, 0)], 0) - starts_of(size), size) + np.arange(len(out))
            out[compound] = self.flat[place[compound]]
        return out, size

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the shard; only the symbols that hold them are expanded."""
        stop = int(self.ends[-1]) if stop is None and len(self.ends) else (stop or 0)
        if stop <= start:
            return np.zeros(0, np.uint32)
        a, b = np.searchsorted(self.ends, [start, stop - 1], "right")
        skipped = int(self.ends[a - 1]) if a else 0
        return self._expand(self.symbols[a:b + 1])[0][start - skipped:stop - skipped]


def write_token_files(docs: DataFrame, tokenizer_path: str, shard_tokens: int = 500_000, id_col: str = "doc_id",
                      text_col: str = "text", path: str | None = None) -> str:
    """Encode ``docs``, compress and write them; returns the folder.

    Null texts count as empty (their only id is :data:`END_ID`); null ids come first; rows of equal id are in order
    of their text.  A document is never split, so a shard holds ``shard_tokens`` ids or one longer document.
    An empty table gives files without rows.  Other columns are ignored.
    """
    spark = docs.sparkSession
    path = path or new_output_dir(spark, "token-files")
    id_type = dict(docs.dtypes)[id_col]
    rows = (docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
            .repartitionByRange("id").sortWithinPartitions("id", "text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(tokenizer_path)
        base = encoder.tok.get_vocab_size()
        part, shard, start = TaskContext.get().partitionId(), 0, 0
        names, ids, sizes, held = [], [], [], 0

        def close():
            nonlocal shard, start, names, ids, sizes, held
            lengths = np.concatenate(sizes)
            rules, rule_lengths, symbols = compress(np.concatenate(ids), lengths, base)
            row = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([shard], pa.int32()), pa.array([start], pa.int64()),
                 pa.array([held], pa.int64()), pa.array([base], pa.int32()), pa.ListArray.from_arrays([0, sum(map(len, names))], pa.concat_arrays(names)),
                 *(pa.array([x.astype("<u4").tobytes()], pa.binary()) for x in (lengths, rules, rule_lengths, symbols))],
                names=["part", "shard", "start", "n_tokens", "base", "doc_ids", "doc_lengths", "rules", "rule_lengths", "symbols"])
            shard, start, names, ids, sizes, held = shard + 1, start + held, [], [], [], 0
            return row

        for b in blocks(batches, "text", 1_500_000):
            got, lengths = encoder.encode(b.column("text").to_pylist())
            begin = starts_of(lengths)
            at = 0
            while at < len(lengths):
                fits = int(np.searchsorted(np.cumsum(lengths[at:]), shard_tokens - held, "right"))
                n = max(fits, 0 if held else 1)
                if n:
                    first, stop = begin[at], begin[at + n - 1] + lengths[at + n - 1]
                    names.append(b.column("id").slice(at, n))
                    ids.append(got[first:stop])
                    sizes.append(lengths[at:at + n])
                    held += int(stop - first)
                    at += n
                if at < len(lengths) or held >= shard_tokens:
                    yield close()
        if held:
            yield close()

    in_arrow(rows, run, f"part int, shard int, start long, n_tokens long, base int, doc_ids array<{id_type}>, "
                        "doc_lengths binary, rules binary, rule_lengths binary, symbols binary").write.parquet(path)
    return path


def read_token_files(spark, path: str, id_col: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document from the files: id, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` and, if asked for, ``ids`` (all little-endian uint32)."""
    shards = spark.read.parquet(path)
    totals = sorted(shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # a row per range partition
    before, offsets = 0, []
    for part, n in totals:
        offsets.append((part, before))
        before += n
    shards = shards.join(F.broadcast(spark.createDataFrame(offsets, "part int, before long")), "part")
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                b = batch.slice(i, 1)
                u4 = lambda c: np.frombuffer(b.column(c)[0].as_py(), "<u4")  # noqa: B023, E731
                lengths = u4("doc_lengths").astype(np.int64)
                shard = Shard(u4("rules").reshape(-1, 2), u4("rule_lengths"), u4("symbols"), b.column("base")[0].as_py())
                raw = shard.ids().astype("<u4").tobytes()
                begin = starts_of(lengths)
                first = b.column("start")[0].as_py() + b.column("before")[0].as_py()
                view = memoryview(raw)
                parts = [view[4 * s:4 * (s + n)] for s, n in zip(begin.tolist(), lengths.tolist())]
                out = [b.column("doc_ids").flatten(), pa.array(first + begin), pa.array(lengths),
                       pa.array(list(map(zlib.crc32, parts)), pa.int64())]
                if with_ids:
                    out.append(pa.array(list(map(bytes, parts)), pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=[id_col, "start", "n_tokens", "ids_crc32", "ids"][:len(out)])

    return in_arrow(shards, run, f"`{id_col}` {id_type}, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids)
