"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece exactly one token can end its encoding. Going left to
right, the automaton over the vocabulary gives all tokens that end at a position;
the one whose predecessor (the last token of the prefix before it) is compatible
with it is stored, and the back-pointers from the end give the ids. Two tokens are
compatible if the merges turn the bytes of both into just these two: undoing the
merges at their seam, latest first, must meet no pair that would have merged earlier.
The answers are remembered per pair.

The vocabulary file is a parameter and is read by each worker; nothing is trained.
Words and pieces seen before are remembered in two generations of bounded size. A word ends at
a space that follows something else than white space: no piece crosses such a space,
and none in front of it depends on what follows. Whole texts are encoded; a null
text is an empty one. Special tokens in a text become their
ids, as the file says. Other columns than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

# Fixed value: how byte-level BPE splits a text before the merges.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
# Words, and pieces, of one generation; a task that does nothing else has room for more.
REMEMBERED = 100_000
REMEMBERED_ALONE = 250_000
PAIRS_REMEMBERED = 300_000
LONGEST_REMEMBERED = 64


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    rest = [b for b in range(256) if b not in set(plain)]
    return letters | {chr(256 + i): b for i, b in enumerate(rest)}


class Memory:
    """What was seen before, in two generations: when the young one is full, the old one is forgotten."""

    def __init__(self, size: int) -> None:
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def keep(self, key: str, value: object) -> None:
        if len(key) <= LONGEST_REMEMBERED:
            if len(self.young) >= self.size:
                self.young, self.old = {}, self.young
            self.young[key] = value


class PrefixBpe:
    """Encoder and decoder for a ``tokenizers`` file with a byte-level BPE model."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self.remembered = remembered
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], _byte_letters()
        split, bpe = spec["pre_tokenizer"], model["type"] == "BPE"
        if not bpe or split["type"] != "ByteLevel" or split["add_prefix_space"] or not split["use_regex"] or spec["normalizer"] or model.get("ignore_merges") or model.get("dropout"):
            raise ValueError(f"{path} is no plain byte-level BPE file")
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        as_bytes = lambda token: bytes(letters[c] for c in token)
        vocabulary = {token: i for token, i in model["vocab"].items() if token not in special}
        self.ids = {as_bytes(token): i for token, i in vocabulary.items()}
        self.token = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in special.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {(as_bytes(a), as_bytes(b)): r for r, (a, b) in enumerate(merges)}
        self.special = special
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.size = max(self.token) + 1
        self.made: dict[int, tuple[int, int, int]] = {}
        self.pair_rank: dict[int, int] = {}
        self.ordered = True
        for (a, b), r in self.rank.items():
            x, y, both = self.ids.get(a), self.ids.get(b), self.ids.get(a + b)
            if x is None or y is None or both is None or both in self.made or any(len(t) > 1 and self.ids[t] not in self.made for t in (a, b)):
                # Merges that are not in the order of their parts, or make a token twice, are played through instead.
                self.ordered = False
                break
            self.made[both] = r, x, y
            self.pair_rank[x * self.size + y] = r
        self.fits: dict[int, bool] = {}
        # Tokens that the merges do not leave whole end no prefix.
        self.whole = {token: i for token, i in self.ids.items() if self._stays(token, i)}
        self.automaton = ahocorasick.Automaton()
        for token, i in self.whole.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, i))
        self.automaton.make_automaton()
        self.words, self.parts = Memory(self.remembered), Memory(self.remembered)
        self.decimals = [str(i) for i in range(self.size)]
        self.spelled = [self.token.get(i, b"") for i in range(self.size)]

    def forget(self) -> None:
        """Free what was remembered, so that a worker that waits for other work holds no more than the tables."""
        self.words, self.parts = Memory(self.remembered), Memory(self.remembered)
        self.fits.clear()

    def _stays(self, token: bytes, i: int) -> bool:
        """The merges turn the token's bytes into just it; in ordered merges, if no pair at the seam of its two parts comes first."""
        if not self.ordered:
            return self.merged(token) == [token]
        if len(token) == 1:
            return True
        made = self.made.get(i)
        return made is not None and self._apart(made[1], made[2], made[0])

    def merged(self, data: bytes) -> list[bytes]:
        """What the merges leave of a short byte string, lowest rank and leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, at = min((self.rank.get(p, 1 << 60), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _apart(self, x: int, y: int, limit: int = 1 << 60) -> bool:
        """No merge of a rank below ``limit`` joins the end of token x with the start of token y before both are whole."""
        byte = (-1, 0, 0)
        while True:
            if self.pair_rank.get(x * self.size + y, limit) < limit:
                return False
            made_x, made_y = self.made.get(x, byte), self.made.get(y, byte)
            if made_x[0] > made_y[0]:
                limit, x = made_x[0], made_x[2]
            elif made_y[0] >= 0:
                # Of two equal merges the left one comes first, so a pair at the seam comes before the one in y.
                limit, y = made_y[0] + 1, made_y[1]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        if len(self.fits) >= PAIRS_REMEMBERED:
            self.fits.clear()
        if self.ordered:
            known = self._apart(left, right)
        else:
            a, b = self.token[left], self.token[right]
            known = self.merged(a + b) == [a, b]
        self.fits[left * self.size + right] = known
        return known

    def piece(self, data: bytes) -> list[int]:
        """Ids of one piece."""
        whole = self.whole.get(data)
        if whole is not None:
            return [whole]
        known, compatible, size = self.fits.get, self.compatible, self.size
        # By the place of its last byte: the last token of each prefix, and where that token begins.
        last, begin = [-1] * len(data), [0] * len(data)
        for end, (less, token) in self.automaton.iter(data.decode("latin-1")):
            if last[end] < 0:
                start = end - less
                if start:
                    before = last[start - 1]
                    if before < 0:
                        continue
                    fit = known(before * size + token)
                    if not (compatible(before, token) if fit is None else fit):
                        continue
                last[end] = token
                begin[end] = start
        out, at = [], len(data)
        while at:
            out.append(last[at - 1])
            at = begin[at - 1]
        out.reverse()
        return out

    def _pieces(self, words: str) -> list[int]:
        parts, pieces = self.parts, PIECES.findall(words)
        if len(pieces) == 1:
            # The word's own memory has it.
            return self.piece(pieces[0].encode())
        ids: list[int] = []
        for piece in pieces:
            found = parts.young.get(piece)
            if found is None:
                found = parts.old.get(piece) or self.piece(piece.encode())
                parts.keep(piece, found)
            ids += found
        return ids

    def _word(self, word: str) -> list[int]:
        """A word and the space before it, not among the young ones."""
        if word.isascii():
            # Plain letters are one piece, and a mark behind them is another; such words are remembered without it.
            if not word[-1].isalnum() and word[:-1].isalpha():
                stem = word[:-1]
                found = self.words.young.get(stem)
                return (found or self._word(stem)) + self.piece(word[-1].encode())
            if word.isalpha():
                found = self.words.old.get(word)
                if found is None:
                    found = self.piece(b" " + word.encode())
                self.words.keep(word, found)
                return found
        found = self.words.old.get(word)
        if found is None:
            found = self._pieces(" " + word)
        self.words.keep(word, found)
        return found

    def _plain(self, text: str, ids: list[int]) -> None:
        """Ids of text without special tokens, added to ``ids``."""
        words, memory, word_ids = text.split(" "), self.words, self._word
        # The first word has no space before it; white space waits for the word that ends it.
        waiting: list[str] = words[:1]
        if words[0] and not words[0][-1].isspace():
            ids += self._pieces(words[0])
            waiting = []
        for word in words[1:]:
            if not waiting:
                found = memory.young.get(word)
                if found is not None:
                    ids += found
                elif word and not word[-1].isspace():
                    ids += word_ids(word)
                else:
                    waiting = ["", word]
            else:
                waiting.append(word)
                if word and not word[-1].isspace():
                    ids += self._pieces(" ".join(waiting))
                    waiting = []
        if waiting:
            ids += self._pieces(" ".join(waiting))

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.cut.split(text) if self.cut and any(s in text for s in self.special) else (text,):
            if part in self.special:
                ids.append(self.special[part])
            else:
                self._plain(part, ids)
        return ids

    def listed(self, ids: list[int]) -> str:
        """Decimals joined by commas."""
        return ",".join(map(self.decimals.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.spelled.__getitem__, ids)).decode("utf-8", "replace")


@lru_cache(2)
def encoder(path: str, remembered: int = REMEMBERED) -> PrefixBpe:
    return PrefixBpe(path, remembered)


def _lists(ids: list[array]) -> pa.Array:
    """Arrow lists of rows of 32-bit numbers."""
    ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(ids), dtype=np.int32)))


def _parts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) for each whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for part in _parts(batches):
            ids = [array("i", bpe.encode(t.as_py() or "")) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), _lists(ids)], names=["doc_id", "ids"])
        bpe.forget()

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of rows with ids."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path)
        for batch in batches:
            texts = [bpe.decode(i.as_py() or []) for i in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], schema=schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def _report(docs: DataFrame, path: str, with_ids: bool, remembered: int = REMEMBERED) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, remembered)
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for part in _parts(batches):
            kept, counts, listed_sha, decoded_sha = [], [], [], []
            for text in part.column("text"):
                ids = bpe.encode(text.as_py() or "")
                counts.append(len(ids))
                listed_sha.append(sha(bpe.listed(ids)))
                decoded_sha.append(sha(bpe.decode(ids)))
                if with_ids:
                    kept.append(array("i", ids))
            columns = {"doc_id": part.column("doc_id"), "n_tokens": pa.array(counts, pa.int64())}
            columns |= {"ids": _lists(kept)} if with_ids else {}
            columns |= {"ids_sha256": pa.array(listed_sha, pa.string()), "decoded_sha256": pa.array(decoded_sha, pa.string())}
            yield pa.RecordBatch.from_pydict(columns)
        bpe.forget()

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n_tokens long, {'ids array<int>, ' if with_ids else ''}ids_sha256 string, decoded_sha256 string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids, ids_sha256, decoded_sha256): ids, and the text they decode to, in one pass."""
    return _report(docs, path, with_ids=True)


def token_report(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ``round_trip`` without the ids themselves."""
    return _report(docs, path, with_ids=False, remembered=REMEMBERED_ALONE)
