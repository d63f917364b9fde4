"""BPE encoding and decoding by forced-boundary splitting.

Byte pairs that occur inside no vocabulary token can never be merged over, so each such pair is a certain cut.
A word falls apart at its cuts into fragments; fragments are encoded by themselves, many at a time, and the ids
are concatenated.

Texts are encoded in slices of bounded size, cut at white space, where no token ends or begins otherwise. Words
met before are remembered in two generations of a bounded number of bytes; words of a slice that are new are
merged together. So a worker's memory follows neither the corpus nor a text's length, but for one run of
characters without white space.

Null and empty texts have no ids and decode to the empty string. Repeated rows are encoded alike, each by itself.
Extra columns pass through; an existing column with an output's name is replaced.
"""

from __future__ import annotations

import heapq
import json
import re
import sys
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

END = "</w>"
#: Bytes of a worker's memory of encoded words, two generations together.
CACHE_BYTES = 48 << 20
#: Of an entry beside its word and ids: two object heads and a place in a dictionary.
ENTRY_BYTES = 190
#: Characters encoded, and ids decoded, at a time.
SLICE_CHARS, SLICE_IDS = 1 << 18, 1 << 18
#: Symbols of a fragment from which merging uses a heap.
LONG = 64
NEVER = np.int32((1 << 31) - 1)
_WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
#: Up to U+024F normalization changes nothing but case, and letters and numbers are the ranges below.
_BEYOND_LATIN = re.compile("[İɐ-\U0010ffff]")
_L, _N = "a-zA-Z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ", "0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN_PIECES = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^\t-\r \x85\xa0{_L}{_N}]+")
_MODELS: dict[int, ForcedBoundaryBpe] = {}


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, otherwise the next one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in plain)}


_BYTE_LETTER = _byte_letters()
_LETTER_BYTE = {c: b for b, c in _BYTE_LETTER.items()}


class ForcedBoundaryBpe:
    """One tokenizer file (BPE with word ends, byte-level letters, no decoder) in memory of a worker.

    Symbols are numbered: 0 to 255 are the bytes within a word, 256 to 511 those at its end, then what merges make.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        loaded, tokenizer = json.loads(spec), Tokenizer.from_str(spec)
        self.normalizer, self.pre_tokenizer = tokenizer.normalizer, tokenizer.pre_tokenizer
        vocab = loaded["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in loaded["added_tokens"]}
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special))) + ")") if self.special else None
        letters = [_BYTE_LETTER[b] for b in range(256)]
        names = {name: i for i, name in enumerate([*letters, *(c + END for c in letters)])}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in loaded["model"]["merges"]]
        for left, right in merges:
            for name in (left, right, left + right):
                names.setdefault(name, len(names))
        self.size = len(names)
        self.ids = np.array([vocab.get(name, -1) for name in names], dtype=np.int32)
        self.merged = np.array([names[left + right] for left, right in merges], dtype=np.int32)
        self.ranks = {names[left] * self.size + names[right]: rank for rank, (left, right) in reversed(list(enumerate(merges)))}
        self.keys = np.array(sorted(self.ranks), dtype=np.int64)
        self.key_ranks = np.array([self.ranks[k] for k in self.keys.tolist()], dtype=np.int32)
        self.joined = np.zeros((512, 512), dtype=bool)
        for token in vocab:
            inside = [_LETTER_BYTE[c] for c in token.removesuffix(END) if c in _LETTER_BYTE]
            if token.endswith(END) and inside:
                inside[-1] += 256
            self.joined[inside[:-1], inside[1:]] = True
        tokens = {i: t for t, i in (vocab | self.special).items()}
        self.tokens = pa.array([tokens.get(i) for i in range(max(tokens) + 1)], pa.string())
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.young_bytes = 0

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], NEVER)

    def fragments(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The symbols of all words, where their fragments start, and each word's first fragment."""
        encoded = [w.encode("utf-8") for w in words]
        ends = np.cumsum([len(w) for w in encoded])
        symbols = np.frombuffer(b"".join(encoded), dtype=np.uint8).astype(np.int32)
        symbols[ends - 1] += 256
        first = np.ones(len(symbols), dtype=bool)
        first[1:] = ~self.joined[symbols[:-1], symbols[1:]]
        first[ends[:-1]] = True
        starts = np.flatnonzero(first)
        return symbols, starts, np.searchsorted(starts, np.concatenate([[0], ends[:-1]]))

    def merge(self, rows: np.ndarray) -> np.ndarray:
        """Merge the best-ranked pair of each row, leftmost first, until none is left; rows are filled up with -1."""
        out, live = np.full_like(rows, -1), np.arange(len(rows))
        rank = self._rank(rows[:, :-1], rows[:, 1:])
        while len(live):
            if rank.shape[1] == 0:
                out[live, :1] = rows
                break
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(live)), at]
            done = best == NEVER
            if done.any():
                out[live[done], : rows.shape[1]] = rows[done]
                live, rows, rank, at, best = live[~done], rows[~done], rank[~done], at[~done], best[~done]
                if not len(live):
                    break
            n, width = np.arange(len(live)), rows.shape[1] - 1
            shifted = np.arange(width)[None, :]
            shifted = shifted + (shifted > at[:, None])
            rows = np.take_along_axis(rows, shifted, axis=1)
            rows[n, at] = self.merged[best]
            shifted = np.arange(width - 1)[None, :]
            rank = np.take_along_axis(rank, shifted + (shifted >= at[:, None]), axis=1)
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 1)
            rank[left, at[left] - 1] = self._rank_or_end(rows[left, at[left] - 1], rows[left, at[left]])
            rank[right, at[right]] = self._rank_or_end(rows[right, at[right]], rows[right, at[right] + 1])
        return out

    def _rank_or_end(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return np.where((left < 0) | (right < 0), NEVER, self._rank(left, right))

    def _merge_long(self, fragment: list[int]) -> list[int]:
        """The same with a heap, for one fragment of any length."""
        parts: list[int | None] = list(fragment)
        n, size = len(parts), self.size
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, a, b) for i, (a, b) in enumerate(zip(fragment, fragment[1:], strict=False)) if (r := self.ranks.get(a * size + b)) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = int(self.merged[rank]), None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.ranks.get(parts[x] * size + parts[y])) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [p for p in parts if p is not None]

    def words(self, words: list[str]) -> list[bytes]:
        """The ids of each word as 32-bit numbers. Fragments of like length are merged together."""
        symbols, starts, first = self.fragments(words)
        lengths = np.diff(starts, append=len(symbols))
        found = np.full(len(symbols), -1, dtype=np.int32)  # a fragment's ids stand where its symbols stood
        alone = starts[lengths == 1]
        found[alone] = self.ids[symbols[alone]]
        low = 1
        while low < LONG:
            group = np.flatnonzero((lengths > low) & (lengths <= 2 * low))
            low *= 2
            if len(group):
                inside = np.arange(low)[None, :] < lengths[group][:, None]
                at = np.minimum(starts[group][:, None] + np.arange(low), len(symbols) - 1)
                merged = self._merged(np.where(inside, symbols[at], -1), inside)
                found[at[inside]] = merged[inside]
        for f in np.flatnonzero(lengths > LONG):
            made = self._merge_long(symbols[starts[f] : starts[f] + lengths[f]].tolist())
            found[starts[f] : starts[f] + len(made)] = self.ids[made]
        kept = found >= 0
        ends = np.concatenate([starts[first], [len(symbols)]])
        offsets = np.concatenate([[0], np.cumsum(kept)])[ends] * 4
        data, offsets = found[kept].tobytes(), offsets.tolist()
        return [data[a:b] for a, b in zip(offsets, offsets[1:], strict=False)]

    def _merged(self, rows: np.ndarray, inside: np.ndarray) -> np.ndarray:
        made = self.merge(rows)
        return np.where((made >= 0) & inside, self.ids[np.maximum(made, 0)], -1)

    def _learn(self, pieces: Iterable[str]) -> None:
        """Have the ids of all ``pieces`` in the young generation."""
        wanted = set(pieces)
        missing = wanted.difference(self.young)
        if not missing:
            return
        if self.young_bytes > CACHE_BYTES // 2:
            self.old, self.young, self.young_bytes = self.young, {}, 0
            missing = wanted
        again = {w: self.old[w] for w in missing if w in self.old}
        marks = {w: self.ids_of(self.special[w]) for w in self.special if w in missing}
        new = list(missing.difference(again).difference(marks))
        again |= marks | dict(zip(new, self.words(new) if new else (), strict=True))
        self.young |= again
        self.young_bytes += ENTRY_BYTES * len(again) + sum(map(sys.getsizeof, again)) + sum(map(len, again.values()))

    @staticmethod
    def ids_of(*ids: int) -> bytes:
        return array("i", ids).tobytes()

    def encode_pieces(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of texts given as pieces."""
        self._learn(p for pieces in texts for p in pieces)
        return [b"".join(map(self.young.__getitem__, pieces)) for pieces in texts]

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as 32-bit numbers."""
        return b"".join(x for part in _parts(text) for x in self.encode_pieces([self.pieces(part)]) if part)

    def pieces(self, text: str) -> list[str]:
        """The words of a text, and its special tokens as they are."""
        if self.split_special and "<|" in text:
            return [p for part in self.split_special.split(text) if part for p in ([part] if part in self.special else self._plain(part))]
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if _BEYOND_LATIN.search(text):
            return [p for chunk in _WHITE.split(text) if chunk for p in self._pieces(chunk)]
        return _LATIN_PIECES.findall(text.lower())

    def _pieces(self, chunk: str) -> list[str]:
        if not _BEYOND_LATIN.search(chunk):
            return _LATIN_PIECES.findall(chunk.lower())
        found = self.pre_tokenizer.pre_tokenize_str(self.normalizer.normalize_str(chunk))
        return [bytes(map(_LETTER_BYTE.__getitem__, piece)).decode("utf-8") for piece, _ in found]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The tokens of each list joined by spaces; ids that the vocabulary lacks are passed over, null lists are empty."""
        known = pc.take(self.tokens, pc.if_else(pc.and_(pc.greater_equal(ids.flatten(), 0), pc.less(ids.flatten(), len(self.tokens))), ids.flatten(), None))
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(), dtype=np.int64)
        if known.null_count:
            valid = known.is_valid().to_numpy(zero_copy_only=False)
            ends, known = np.concatenate([[0], np.cumsum(valid)])[ends], known.drop_null()
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), known), " ")


def _parts(text: str | None) -> Iterator[str]:
    """A text in parts of about SLICE_CHARS, cut before white space."""
    at, n = 0, len(text or "")
    while n - at > SLICE_CHARS:
        white = _WHITE.search(text, at + SLICE_CHARS)
        if not white:
            break
        yield text[at : white.start()]
        at = white.start()
    if n:
        yield text[at:]


def _encoded(model: ForcedBoundaryBpe, texts: pa.Array) -> Iterator[tuple[int, bytes]]:
    """(row, ids) of the parts of all texts, in order; rows without words are left out. Short texts are encoded together."""
    rows: list[int] = []
    held: list[list[str]] = []
    chars = 0
    for row, text in enumerate(texts):
        for part in _parts(text.as_py()):
            rows.append(row)
            held.append(model.pieces(part))
            chars += len(part)
            if chars >= SLICE_CHARS:
                yield from zip(rows, model.encode_pieces(held), strict=True)
                rows, held, chars = [], [], 0
    yield from zip(rows, model.encode_pieces(held), strict=True)


def _model(spec: str) -> ForcedBoundaryBpe:
    key = hash(spec)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = ForcedBoundaryBpe(spec)
    return _MODELS[key]


def _shared_spec(spark: SparkSession, path: str):
    """The tokenizer file, read once on the driver; its size is that of one vocabulary, whatever the corpus."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def encoder(spark: SparkSession, path: str):
    """A column function text -> array<int> of token ids."""
    spec = _shared_spec(spark, path)

    @F.arrow_udf("array<int>")
    def encode_texts(texts: pa.Array) -> pa.Array:
        model = _model(spec.value)
        lengths, data = np.zeros(len(texts) + 1, dtype=np.int64), array("i")
        for row, ids in _encoded(model, texts):
            lengths[row + 1] += len(ids) // 4
            data.frombytes(ids)
        return pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(np.frombuffer(data, dtype=np.int32)))

    return encode_texts


def decoder(spark: SparkSession, path: str):
    """A column function array<int> -> text; ids that the vocabulary lacks are passed over."""
    spec = _shared_spec(spark, path)

    @F.arrow_udf("string")
    def decode_ids(ids: pa.Array) -> pa.Array:
        model, sizes = _model(spec.value), np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())
        cuts = [0, *(np.flatnonzero(np.diff(sizes // SLICE_IDS)) + 1).tolist(), len(ids)]
        done = [model.decode(ids[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]
        return pa.concat_arrays(done) if done else pa.array([], pa.string())

    return decode_ids


def counter(spark: SparkSession, path: str):
    """A column function text -> number of tokens, without sending the ids back."""
    spec = _shared_spec(spark, path)

    @F.arrow_udf("bigint")
    def count_tokens(texts: pa.Array) -> pa.Array:
        model = _model(spec.value)
        lengths = np.zeros(len(texts), dtype=np.int64)
        for row, ids in _encoded(model, texts):
            lengths[row] += len(ids) // 4
        return pa.array(lengths)

    return count_tokens


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "token_ids") -> DataFrame:
    """``df`` with the token ids of ``text``; an empty array for null or empty texts."""
    return df.withColumn(ids, encoder(df.sparkSession, path)(F.col(text)))


def decode(df: DataFrame, path: str, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids``; the empty string for null or empty arrays."""
    return df.withColumn(text, decoder(df.sparkSession, path)(F.col(ids)))


def ids_digest(ids: Column) -> Column:
    """SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " ").cast("binary"), 256)


def digests(df: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens and the digests of ids and decoded text, through ``encode`` and ``decode``."""
    done = decode(encode(df.select("doc_id", "text"), path), path)
    return done.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), ids_digest(F.col("token_ids")).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
