"""BPE encoding by speculation and verification, and decoding.

Greedy longest match proposes the tokens of every distinct word. The proposal is the BPE
encoding exactly if every two neighbouring tokens are compatible, that is if merging their
joint text leaves those two. Compatibility is tested for all neighbours of all words of a
batch at once by undoing the merges on both sides of the border, latest first, and asking
at each step whether the two pieces then meeting would have been merged before. Only words
with an incompatible pair are merged rule by rule.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import pathlib
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import bound_batches, kept, pick

#: Distinct pieces of text a worker remembers, and characters it encodes at a time.
REMEMBERED = 350_000
AT_ONCE = 4 << 20
#: A word of more letters is merged by itself, without a proposal.
LONG = 64

_NEVER = np.int64(1) << 60

#: White space as Unicode defines it, for a character class; fixed values.
_SPACE = "\\t-\\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Characters that str.split() takes for white space and Unicode does not.
_NOT_SPACE = frozenset("\x1c\x1d\x1e\x1f")
_cut_at_space = regex.compile(f"[^{_SPACE}]+").findall


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable bytes stand for themselves; the others take the code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class WordBpe:
    """A BPE vocabulary with word ends, as the tokenizers library stores it.

    The text is put into NFC, white space is collapsed, every character is lower-cased, words
    are cut out by the vocabulary's pattern, their bytes become letters, and the last letter
    of a word carries the end mark. Special tokens in a text are kept as they are.
    """

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.names = {i: t for t, i in (self.vocab | self.specials).items()}
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words_in = regex.compile(pattern.replace(r"\s", _SPACE)).findall
        self.special_in = regex.compile("|".join(regex.escape(t) for t in self.specials)) if self.specials else None
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(byte_letters())})
        self.plain = {chr(b) for b, c in enumerate(byte_letters()) if chr(b) == c}
        self._read_merges(model["merges"])
        self.remembered: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    def _read_merges(self, merges: Iterable) -> None:
        pairs = [tuple(m) if isinstance(m, (list, tuple)) else tuple(m.split(" ")) for m in merges]
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(pairs):
            self.merges.setdefault((self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        size = max(self.names) + 1
        self.rank = np.full(size, -1, dtype=np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        for (a, b), (rank, token) in self.merges.items():
            if self.rank[token] < 0:
                self.rank[token], self.left[token], self.right[token] = rank, a, b
        keys = np.array([a * size + b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.size = keys[order], size
        self.key_ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.key_tokens = np.array([t for _, t in self.merges.values()], dtype=np.int64)[order]
        self._grow_trie()

    def _grow_trie(self) -> None:
        """The tokens that merging can make, letter by letter, as sorted arrays of steps."""
        spelled = [(t, i, self._symbols(t)) for t, i in self.vocab.items()]
        spelled = [x for x in spelled if x[2]]
        steps: dict[int, int] = {}
        ends: tuple[dict, dict] = {}, {}  # tokens inside a word and at its end, by node
        for (token, number, _), made in zip(spelled, self.merge_all([x[2] for x in spelled])):
            if made != [number]:
                continue  # greedy may not propose it
            marked = self._marked(token)
            node = 0
            for letter in token[: -len(self.end)] if marked else token:
                node = steps.setdefault(node << 9 | ord(letter), len(steps) + 1)
            ends[marked][node] = number
        order = np.argsort(np.fromiter(steps, np.int64, len(steps)))
        self.steps = np.fromiter(steps, np.int64, len(steps))[order]
        self.nodes = np.fromiter(steps.values(), np.int64, len(steps))[order]
        self.inside, self.final = (np.full(len(steps) + 1, -1, dtype=np.int64) for _ in range(2))
        for table, found in zip((self.inside, self.final), ends):
            table[np.fromiter(found, np.int64, len(found))] = np.fromiter(found.values(), np.int64, len(found))

    def _marked(self, token: str) -> bool:
        return token.endswith(self.end) and token != self.end

    def _symbols(self, token: str) -> list[int] | None:
        marked = self._marked(token)
        body = token[: -len(self.end)] if marked else token
        symbols = [self.vocab.get(s) for s in (*body[:-1], body[-1] + self.end if marked else body[-1])]
        return None if None in symbols else symbols

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranks of the rules that merge the pairs (never, if there is none) and what they make."""
        key = left * self.size + right
        slot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        known = (self.keys[slot] == key) & (left >= 0) & (right >= 0)
        return np.where(known, self.key_ranks[slot], _NEVER), self.key_tokens[slot]

    def merge_all(self, spelled: list[list[int]]) -> list[list[int]]:
        """Exact merging of many words side by side: in each the lowest rank first, leftmost first."""
        out = [self._merge_long(w) if len(w) > LONG else [] for w in spelled]
        by_size = sorted((i for i, w in enumerate(spelled) if len(w) <= LONG), key=lambda i: len(spelled[i]))
        at = 0
        while at < len(by_size):
            longest = max(16, 2 * len(spelled[by_size[at]]))  # words of like size share a table
            stop = at
            while stop < len(by_size) and len(spelled[by_size[stop]]) <= longest and (stop - at) * longest < 1 << 20:
                stop += 1
            chosen = by_size[at : max(stop, at + 1)]
            for i, made in zip(chosen, self._merge_table([spelled[i] for i in chosen])):
                out[i] = made
            at += len(chosen)
        return out

    def _merge_table(self, spelled: list[list[int]]) -> Iterator[list[int]]:
        width = max(2, max(map(len, spelled)))
        symbols = np.full((len(spelled), width), -1, dtype=np.int64)
        for row, word in zip(symbols, spelled):
            row[: len(word)] = word
        ranks, made = self._rank_of(symbols[:, :-1], symbols[:, 1:])
        rows = np.arange(len(spelled))
        columns = np.arange(width)
        while len(rows):
            spot = ranks[rows].argmin(axis=1)
            going = ranks[rows, spot] < _NEVER
            rows, spot = rows[going], spot[going]
            if not len(rows):
                break
            symbols[rows, spot] = made[rows, spot]
            behind = np.minimum(columns + (columns > spot[:, None]), width - 1)
            closed = np.take_along_axis(symbols[rows], behind, axis=1)
            closed[:, -1] = -1
            symbols[rows] = closed
            behind = np.minimum(columns[:-1] + (columns[:-1] >= spot[:, None]), width - 2)
            for table in (ranks, made):
                table[rows] = np.take_along_axis(table[rows], behind, axis=1)
            ranks[rows, -1] = _NEVER
            for near in (spot - 1, spot):
                there = (near >= 0) & (near < width - 1)
                r, c = rows[there], near[there]
                ranks[r, c], made[r, c] = self._rank_of(symbols[r, c], symbols[r, c + 1])
        for row in symbols.tolist():
            yield row[: row.index(-1)] if row[-1] < 0 else row

    def _merge_long(self, symbols: list[int]) -> list[int]:
        """Exact merging of one long word, in time proportional to its length but for a logarithm."""
        symbols, n = list(symbols), len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(self.merges[p][0], i, *p) for i, p in enumerate(zip(symbols, symbols[1:])) if p in self.merges]
        heapq.heapify(heap)
        while heap:
            _, at, a, b = heapq.heappop(heap)
            then = after[at]
            if symbols[at] != a or then >= n or symbols[then] != b:
                continue  # one of the two has been merged meanwhile
            symbols[at], symbols[then] = self.merges[a, b][1], -1
            after[at] = after[then]
            if after[at] < n:
                before[after[at]] = at
            for i in (before[at], at):
                if i >= 0 and after[i] < n and (p := (symbols[i], symbols[after[i]])) in self.merges:
                    heapq.heappush(heap, (self.merges[p][0], i, *p))
        return [s for s in symbols if s >= 0]

    def propose(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match of words in letters: all tokens, and the word each belongs to."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        letters = np.frombuffer("".join(words).encode("utf-16-le"), "<u2").astype(np.int64)
        ends = np.cumsum(sizes)
        at, word = ends - sizes, np.arange(len(words))
        tokens, owners = [], []
        while len(word):
            node, reach = np.zeros(len(word), np.int64), at.copy()
            token, stop, going = np.full(len(word), -1), at.copy(), np.arange(len(word))
            while len(going):
                key = node[going] << 9 | letters[reach[going]]
                slot = np.minimum(np.searchsorted(self.steps, key), len(self.steps) - 1)
                on = self.steps[slot] == key
                going = going[on]
                node[going] = self.nodes[slot[on]]
                reach[going] += 1
                last = reach[going] == ends[word[going]]
                found = np.where(last, self.final[node[going]], self.inside[node[going]])
                hit = going[found >= 0]
                token[hit], stop[hit] = found[found >= 0], reach[hit]
                going = going[~last]
            if (token < 0).any():
                raise ValueError("a letter has no token in this vocabulary")
            tokens.append(token)
            owners.append(word)
            more = stop < ends[word]
            at, word = stop[more], word[more]
        owner = np.concatenate(owners) if owners else np.empty(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return (np.concatenate(tokens)[order] if tokens else owner), owner[order]

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether each pair of tokens stays as it is when their joint text is merged.

        Times are twice the ranks; a border met by equal rules is merged from the left, so
        a rule that uses up the right piece leaves half a step more than one on the left.
        """
        fine = np.ones(len(left), dtype=bool)
        at, limit = np.arange(len(left)), np.full(len(left), _NEVER)
        x, y = left.copy(), right.copy()
        while len(at):
            clash = 2 * self._rank_of(x, y)[0] < limit
            fine[at[clash]] = False
            rx, ry = self.rank[x], self.rank[y]
            on = ~clash & (np.maximum(rx, ry) >= 0)
            at, x, y, rx, ry = at[on], x[on], y[on], rx[on], ry[on]
            later = rx > ry  # the piece made last is taken apart first
            limit = np.where(later, 2 * rx, 2 * ry + 1)
            x, y = np.where(later, self.right[x], x), np.where(later, y, self.left[y])
        return fine

    def encode_words(self, words: list[str]) -> list[bytes]:
        """The tokens of distinct words (in letters), packed."""
        long = [i for i, w in enumerate(words) if len(w) > LONG]
        skipped = set(long)
        short = [i for i in range(len(words)) if i not in skipped] if long else range(len(words))
        chosen = [words[i] for i in short] if long else words
        flat, owner = self.propose(chosen)
        inside = np.flatnonzero(owner[1:] == owner[:-1])
        pairs, which = np.unique(flat[inside] * self.size + flat[inside + 1], return_inverse=True)
        fine = self.compatible(pairs // self.size, pairs % self.size)[which]
        ends = np.searchsorted(owner, np.arange(len(chosen) + 1)).tolist()
        packed = flat.astype("<u4").tobytes()
        out = [packed[4 * a : 4 * b] for a, b in zip(ends, ends[1:])]
        if long:
            placed = dict(zip(short, out))
            out = [placed.get(i, b"") for i in range(len(words))]
        again = [short[i] for i in np.unique(owner[inside[~fine]]).tolist()] + long
        spelled = [[self.vocab[c] for c in (*words[i][:-1], words[i][-1] + self.end)] for i in again]
        for i, made in zip(again, self.merge_all(spelled)):
            out[i] = np.array(made, dtype="<u4").tobytes()
        return out

    def _words(self, piece: str) -> list[str]:
        """The words of a piece without white space and special tokens, in letters."""
        if not piece.isascii():
            piece = unicodedata.normalize("NFC", piece)
        # one character at a time where it matters: the rule for a final sigma does not apply
        piece = "".join(c.lower() for c in piece) if "\u03a3" in piece else piece.lower()
        body = piece.rstrip(".,")
        found = [w for w in (body, piece[len(body) :]) if w] if body.isalpha() else self.words_in(piece)
        if piece.isascii() and self.plain.issuperset(piece):
            return found
        return [w.encode().decode("latin-1").translate(self.letters) for w in found]

    def _learn(self, pieces: Iterable[str]) -> None:
        """Encode pieces not met yet."""
        parts: dict[str, list] = {}
        for piece in pieces:
            cut, done = [], 0
            if self.special_in is not None and "<" in piece:
                for m in self.special_in.finditer(piece):
                    cut += [*self._words(piece[done : m.start()]), self.specials[m[0]]]
                    done = m.end()
            parts[piece] = [*cut, *self._words(piece[done:])]
        words = list({w for cut in parts.values() for w in cut if isinstance(w, str)}.difference(self.words))
        self.words |= zip(words, self.encode_words(words))
        for piece, cut in parts.items():
            self.remembered[piece] = b"".join(
                [self.words[w] if isinstance(w, str) else w.to_bytes(4, "little") for w in cut]
            )

    def encode(self, texts: Iterable[str | None], at_once: int = AT_ONCE) -> Iterator[np.ndarray]:
        """The token ids of each text; none for a null. Fewer characters ``at_once`` take less memory and more time."""
        block: list[list[str]] = []
        n = 0
        for text in texts:
            block.append(self._pieces(text) if text else [])
            n += len(text) if text else 0
            if n >= at_once:
                yield from self._encode_block(block)
                block, n = [], 0
        yield from self._encode_block(block)

    @staticmethod
    def _pieces(text: str) -> list[str]:
        return text.split() if _NOT_SPACE.isdisjoint(text) else _cut_at_space(text)

    def _encode_block(self, block: list[list[str]]) -> Iterator[np.ndarray]:
        needed = set().union(*block)
        if len(self.remembered) > REMEMBERED:
            self.remembered = {p: self.remembered[p] for p in needed if p in self.remembered}
        if len(self.words) > REMEMBERED:
            self.words.clear()
        self._learn(needed.difference(self.remembered))
        known = self.remembered.__getitem__
        for pieces in block:
            yield np.frombuffer(b"".join(map(known, pieces)), "<u4")

    def decode(self, ids: Iterable[int]) -> str:
        """The tokens with a space between, as the library joins them without a decoder."""
        names = self.names
        return " ".join([names[i] for i in ids if i in names])


class Vocabulary:
    """The vocabulary file as sent to the workers; each opens it once."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        bound_batches(spark)
        self.spec = spark.sparkContext.broadcast(pathlib.Path(path).read_bytes())

    def open(self) -> WordBpe:
        return kept(("words", hash(self.spec.value)), lambda: WordBpe(json.loads(self.spec.value)))


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of int) per row; an empty array for a null or empty text."""
    vocabulary = Vocabulary(docs.sparkSession, path)

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series([t.astype(np.int32) for t in vocabulary.open().encode(texts)], dtype=object)

    return pick(docs, doc_id=id_col, text=text_col).select("doc_id", ids("text").alias("ids"))


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id``, ``text`` per row of token ids; null for null ids, unknown ids are passed over."""
    vocabulary = Vocabulary(encoded.sparkSession, path)

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        decode = vocabulary.open().decode
        return pd.Series([None if i is None else decode(i.tolist()) for i in ids], dtype=object)

    return pick(encoded, doc_id=id_col, ids=ids_col).select("doc_id", text("ids").alias("text"))


def round_trips(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", at_once: int = AT_ONCE) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` per row of ``docs``.

    Every whole text is encoded and its ids decoded again in the task that holds it; only the
    digests leave the task. A null text counts as empty: no tokens, and the digests of an
    empty string. Repeated rows, null ids and other columns make no difference; an empty
    table gives an empty result.
    """
    vocabulary = Vocabulary(docs.sparkSession, path)

    @F.pandas_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def digests(texts: pd.Series) -> pd.DataFrame:
        bpe = vocabulary.open()
        rows = []
        for encoded in bpe.encode(texts, at_once):
            ids = encoded.tolist()
            rows.append((
                len(ids),
                hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                hashlib.sha256(bpe.decode(ids).encode()).hexdigest(),
            ))
        return pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    return pick(docs, doc_id=id_col, text=text_col).select("doc_id", digests("text").alias("r")).select("doc_id", "r.*")
