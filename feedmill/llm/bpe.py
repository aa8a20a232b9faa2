"""Byte-level BPE encoding and decoding by a segment tree over adjacent pair ranks.

The leaves of the tree are the positions of a word; each holds the merge rank of the pair
that starts there, shifted left and joined with the position, so that the smallest value
is the leftmost pair of the lowest rank. The root therefore names the next merge. A merge
changes at most three leaves (the pair before, the merged pair, the pair it swallowed),
each repaired along one path to the root. Encoding ends when the root holds no pair.

Short words, nearly all of a text, go through the same tree together: one row a word, the
paths of all rows repaired at once in numpy.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from feedmill.llm.pieces import PieceEncoder, id_type, in_slices
from feedmill.llm.tables import give_back, text_of

# How byte-level vocabularies of this family split a text before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Longest word, in bytes, for the common tree of many words.
SHORT = 64
_NONE = np.int64(1) << 60
_codecs: dict[str, "Codec"] = {}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in such vocabularies: printable Latin-1 bytes
    stand for themselves, the others for the letters from U+0100 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Codec:
    """Vocabulary and merges of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        vocab: dict[str, int] = data["model"]["vocab"]
        letters = byte_letters()
        back = {letter: b for b, letter in enumerate(letters)}
        self.specials = {x["content"]: x["id"] for x in data["added_tokens"]}
        size = max([*vocab.values(), *self.specials.values()]) + 1
        self.kind = id_type(size)
        self.token_bytes: list[bytes] = [b""] * size
        for token, number in vocab.items():
            self.token_bytes[number] = bytes(back[c] for c in token)
        for token, number in self.specials.items():
            self.token_bytes[number] = token.encode()
        self.decimal = [str(number) for number in range(size)]
        self.of_byte = np.array([vocab[letter] for letter in letters], dtype=np.int64)
        self.width = int(size).bit_length()
        merges = [pair if isinstance(pair, list) else pair.split(" ") for pair in data["model"]["merges"]]
        self.pairs: dict[int, tuple[int, int]] = {}
        for rank, (left, right) in enumerate(merges):
            self.pairs.setdefault(vocab[left] << self.width | vocab[right], (rank, vocab[left + right]))
        keys = np.array(sorted(self.pairs), dtype=np.int64)
        found = np.array([self.pairs[k] for k in keys.tolist()], dtype=np.int64).reshape(-1, 2)
        # A table of the pairs with open addressing: a lookup of many pairs is a few
        # array reads, most often one.
        self.slots = 1 << max(4, (4 * len(keys)).bit_length())
        self.slot_key = np.full(self.slots, -1, dtype=np.int64)
        self.slot_rank = np.full(self.slots, _NONE, dtype=np.int64)
        self.slot_id = np.zeros(self.slots, dtype=np.int64)
        open_keys = np.arange(len(keys))
        at = self._slot(keys)
        while len(open_keys):
            free = self.slot_key[at] < 0
            first = np.zeros(len(at), dtype=bool)
            first[np.unique(at, return_index=True)[1]] = True
            put = free & first
            self.slot_key[at[put]] = keys[open_keys[put]]
            self.slot_rank[at[put]] = found[open_keys[put], 0]
            self.slot_id[at[put]] = found[open_keys[put], 1]
            open_keys, at = open_keys[~put], (at[~put] + 1) & (self.slots - 1)
        self.words = regex.compile(WORDS)
        self.encoder = PieceEncoder(
            self.encode_parts, {t: np.array([n], dtype=self.kind).tobytes() for t, n in self.specials.items()})

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(65 - int(self.slots).bit_length())).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged id of each pair; a rank of ``_NONE`` where there is no merge."""
        keys = left << self.width | right
        at = self._slot(keys)
        rank = np.full(len(keys), _NONE)
        merged = np.zeros(len(keys), dtype=np.int64)
        rows = np.arange(len(keys))
        while len(rows):
            there = self.slot_key[at]
            hit = there == keys[rows]
            rank[rows[hit]] = self.slot_rank[at[hit]]
            merged[rows[hit]] = self.slot_id[at[hit]]
            on = ~hit & (there >= 0)
            rows, at = rows[on], (at[on] + 1) & (self.slots - 1)
        return rank, merged

    # --- merging -------------------------------------------------------------------

    def merge_word(self, word: bytes) -> list[int]:
        """Merge one word, of any length, in its own tree."""
        ids = self.of_byte[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        width = 1 << max(0, (n - 1).bit_length())
        shift, none = width.bit_length(), int(_NONE)
        tree = [none] * (2 * width)
        result = [0] * n
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))

        def leaf(at: int) -> int:
            if after[at] < n and (pair := self.pairs.get(ids[at] << self.width | ids[after[at]])):
                result[at] = pair[1]
                return pair[0] << shift | at
            return none

        def put(at: int) -> None:
            node = at + width
            tree[node] = leaf(at)
            while node > 1:
                node >>= 1
                low, high = tree[2 * node], tree[2 * node + 1]
                tree[node] = low if low < high else high

        for at in range(n):
            tree[at + width] = leaf(at)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            at = tree[1] & ((1 << shift) - 1)
            gone = after[at]
            ids[at] = result[at]
            after[at] = after[gone]
            if after[at] < n:
                before[after[at]] = at
            after[gone] = n
            put(gone)
            put(at)
            if before[at] >= 0:
                put(before[at])
        out, at = [], 0
        while at < n:
            out.append(ids[at])
            at = after[at]
        return out

    def merge_short(self, words: list[bytes]) -> list[bytes]:
        """Merge many words of one width class at once: row ``r`` of the arrays is word ``r``."""
        rows = len(words)
        lengths = np.array([len(w) for w in words])
        width = 1 << int(lengths.max() - 1).bit_length() if lengths.max() > 1 else 1
        shift = width.bit_length()
        letters = np.zeros((rows, width), dtype=np.uint8)
        inside = np.arange(width) < lengths[:, None]
        letters[inside] = np.frombuffer(b"".join(words), np.uint8)
        ids = self.of_byte[letters]
        result = np.zeros((rows, width), dtype=np.int64)
        after = np.tile(np.arange(1, width + 1), (rows, 1))
        before = np.tile(np.arange(-1, width - 1), (rows, 1))
        alive = inside.copy()
        tree = np.full((rows, 2 * width), _NONE)
        r, c = np.nonzero(np.arange(1, width + 1) < lengths[:, None])
        rank, merged = self.look_up(ids[r, c], ids[r, c + 1])
        tree[r, width + c] = np.where(rank < _NONE, rank << shift | c, _NONE)
        result[r, c] = merged
        level = width
        while level > 1:
            half = level // 2
            tree[:, half:level] = np.minimum(tree[:, level:2 * level:2], tree[:, level + 1:2 * level:2])
            level = half

        def repair(r: np.ndarray, c: np.ndarray) -> None:
            node = c + width
            while len(node) and node[0] > 1:
                node = node >> 1
                tree[r, node] = np.minimum(tree[r, 2 * node], tree[r, 2 * node + 1])

        def renew(r: np.ndarray, c: np.ndarray) -> None:
            right = after[r, c]
            value = np.full(len(r), _NONE)
            has = right < lengths[r]
            rh, ch = r[has], c[has]
            rank, merged = self.look_up(ids[rh, ch], ids[rh, right[has]])
            value[has] = np.where(rank < _NONE, rank << shift | ch, _NONE)
            result[rh, ch] = merged
            tree[r, c + width] = value
            repair(r, c)

        r = np.nonzero(tree[:, 1] < _NONE)[0]
        while len(r):
            c = tree[r, 1] & ((1 << shift) - 1)
            gone = after[r, c]
            ids[r, c] = result[r, c]
            alive[r, gone] = False
            beyond = after[r, gone]
            after[r, c] = beyond
            has = beyond < lengths[r]
            before[r[has], beyond[has]] = c[has]
            tree[r, gone + width] = _NONE
            repair(r, gone)
            renew(r, c)
            left = before[r, c]
            has = left >= 0
            renew(r[has], left[has])
            r = r[tree[r, 1] < _NONE]
        packed = ids[alive].astype(self.kind).tobytes()
        ends = (np.cumsum(alive.sum(axis=1)) * self.kind.itemsize).tolist()
        return [packed[start:end] for start, end in zip([0, *ends], ends, strict=False)]

    def encode_parts(self, parts: list[str]) -> list[bytes]:
        """The packed ids of each part; a word that several parts share is merged once."""
        cut = [self.words.findall(part) for part in parts]
        merged: dict[str, bytes] = dict.fromkeys(word for words in cut for word in words)
        classes: dict[int, list[str]] = {}
        for word in merged:
            size = len(word) if word.isascii() else len(word.encode())
            if size > SHORT:
                merged[word] = np.array(self.merge_word(word.encode()), dtype=self.kind).tobytes()
            else:
                classes.setdefault((size - 1).bit_length(), []).append(word)
        for members in classes.values():
            for start in range(0, len(members), 4096):
                some = members[start:start + 4096]
                merged.update(zip(some, self.merge_short([word.encode() for word in some]), strict=True))
        return [b"".join(map(merged.__getitem__, words)) for words in cut]

    # --- whole texts ---------------------------------------------------------------

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of every text."""
        return [np.frombuffer(packed, dtype=self.kind) for packed in self.encoder.encode(texts)]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.token_bytes.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """The codec of a tokenizer file, built once a process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode_decode(
    docs: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """Encode every text, decode the ids again, and describe both.

    One row a document: doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256 (of the decoded text in UTF-8), and with ``with_ids`` the ids themselves.
    A null text is empty: no ids, both digests those of nothing. Rows that repeat or whose
    id is null are kept as they are; other columns are ignored. A text may be of any length.
    Nothing is shuffled.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(tokenizer_path)
        for batch in batches:
            doc_ids = iter(batch.column(0).to_pylist())
            for texts in in_slices(batch.column(1).to_pylist()):
                out: dict[str, list] = {"doc_id": [], "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
                arrays = []
                for ids in own.encode(texts):
                    numbers = ids.tolist()
                    out["doc_id"].append(next(doc_ids))
                    out["n_tokens"].append(len(numbers))
                    out["ids_sha256"].append(hashlib.sha256(",".join(map(own.decimal.__getitem__, numbers)).encode()).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(own.decode(numbers).encode()).hexdigest())
                    if with_ids:
                        arrays.append(ids.astype(np.int32))
                columns = [pa.array(out["doc_id"], pa.int64()), pa.array(out["n_tokens"], pa.int64()),
                           pa.array(out["ids_sha256"], pa.string()), pa.array(out["decoded_sha256"], pa.string())]
                if with_ids:
                    ends = np.cumsum([0] + [len(a) for a in arrays]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays))))
                yield pa.RecordBatch.from_arrays(columns, names=[*out, *(["ids"] if with_ids else [])])
        own.encoder.forget()
        give_back()

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(run, schema)
