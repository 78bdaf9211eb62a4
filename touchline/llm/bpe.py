"""BPE encoding and decoding: tokens are guessed by longest match, checked pair by pair, merged if wrong.

A word's guess takes the longest token at each place, from left to right. A row of tokens is what the
merges make of its text if and only if each token is what they make of its own text, and each two
neighbours are what they make of theirs. The first is checked once per vocabulary, and only such
tokens are guessed. The second is checked for all different pairs of a batch at once, by undoing
the merges of both sides back to single symbols and looking for a merge across the gap that
would have come first. Words that fail, or that end in the middle of a longest match, are merged
exactly, lowest rank first.

The vocabulary is a file of the ``tokenizers`` library: a byte-level BPE whose words end in a mark,
do not reach across white space, and whose merges each make a token of their own. Anything else
raises ``ValueError``. Words seen before are remembered, within a bound, per Python worker.

Defined results: a NULL or empty text has no ids and decodes to an empty text; added tokens of the
vocabulary that stand in a text become their one id; NULL ids of documents are kept; rows that
repeat an id are encoded one by one; half of a surrogate pair cannot occur in a column of strings. Other
columns are kept by ``encode`` and ``decode``, but for those they write.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: How the vocabulary splits lower-cased words.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")
#: Up to here letters are lower-cased one by one, and none of them composes with another; but for İ.
BEYOND_LATIN = re.compile("[^\x00-ɏ]|İ")
#: White space for str.split() that is none for the vocabulary.
SEPARATORS = "\x1c\x1d\x1e\x1f"
NEVER = np.iinfo(np.int64).max


def beyond_latin(text: str) -> bool:
    if text.isascii():
        return False
    try:
        text.encode("latin-1")  # faster than a search
    except UnicodeEncodeError:
        return bool(BEYOND_LATIN.search(text))
    return False


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


def _gather(table: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches ``which`` of a table that holds stretches of the given lengths, end to end, and
    where each of them ends."""
    widths = lengths[which]
    ends = np.cumsum(widths)
    places = np.repeat((np.cumsum(lengths) - lengths)[which] - (ends - widths), widths)
    places += np.arange(len(places))
    return table[places], ends


class Vocabulary:
    """Tokens, merges and what follows from them.

    ``rank`` of a token is that of the merge that makes it, -1 for a symbol; ``left`` and ``right``
    are the two tokens merged. ``whole`` are the tokens that their own text gives.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            written = json.load(file)
        model = written["model"]
        suffix = model.get("end_of_word_suffix")
        plain = not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "byte_fallback", "ignore_merges"))
        if model["type"] != "BPE" or not suffix or not plain or written.get("decoder"):
            raise ValueError(f"{path} is no byte-level BPE with word ends")
        self.ids: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in written["added_tokens"]}
        if any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in written["added_tokens"]):
            raise ValueError(f"{path} has added tokens that change the text around them")
        self.size = 1 + max([*self.ids.values(), *self.added.values()])
        self.texts = [""] * self.size
        for text, i in [*self.ids.items(), *self.added.items()]:
            self.texts[i] = text
        symbols = byte_symbols()
        if any(s + end not in self.ids for s in symbols for end in ("", suffix)):
            raise ValueError(f"{path} has no token for some byte")
        self.byte_of = {s: b for b, s in enumerate(symbols)}
        self._shown = np.array([10 if b == 10 else ord(s) for b, s in enumerate(symbols)], dtype="<u4")
        self._read_merges(path, model["merges"])
        self._find_whole(suffix)

    def _read_merges(self, path: str, merges: list) -> None:
        self.rank = np.full(self.size, -1, dtype=np.int64)
        self.left = np.zeros(self.size, dtype=np.int64)
        self.right = np.zeros(self.size, dtype=np.int64)
        #: (left, right) -> (rank, token)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(merges):
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            left, right, made = self.ids[a], self.ids[b], self.ids[a + b]
            if self.rank[made] >= 0 or (left, right) in self.merges:
                raise ValueError(f"{path} makes a token by two merges")
            self.rank[made], self.left[made], self.right[made] = rank, left, right
            self.merges[left, right] = rank, made
        pairs = np.array(list(self.merges), dtype=np.int64).reshape(-1, 2)
        if (self.rank[pairs].max(axis=1) >= np.arange(len(pairs))).any():
            raise ValueError(f"{path} uses a token before it is made")
        self.made = np.array([token for _, token in self.merges.values()], dtype=np.int64)
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        self._by_key = np.argsort(keys)
        self._keys = keys[self._by_key]

    def show(self, written: bytes) -> np.ndarray:
        """The byte symbols of words that end in line breaks, which stay."""
        return self._shown[np.frombuffer(written, np.uint8)]

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of the merge of each pair, or ``NEVER``."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._by_key[at], NEVER)

    def merged_across(self, left: np.ndarray, right: np.ndarray, but_last: bool = False) -> np.ndarray:
        """Whether merging the joined text of each pair ever joins the end of the left token's
        text to the start of the right one's; ``but_last`` leaves out a merge of the two themselves.

        Both sides are undone from the latest merge back. A merge of the two innermost tokens
        comes first if its rank is below that of the merge which takes the left one, and not above
        that of the merge which takes the right one: of equal merges, the leftmost comes first.
        """
        bad = np.zeros(len(left), dtype=bool)
        open_ = np.arange(len(left))
        x, y = left.astype(np.int64), right.astype(np.int64)
        taken_x, taken_y = np.full(len(left), NEVER), np.full(len(left), NEVER)
        first = True
        while len(open_):
            rank = self.pair_ranks(x, y)
            found = (rank < taken_x) & (rank <= taken_y) & (rank != NEVER)
            if first and but_last:
                found[:] = False
            first = False
            bad[open_[found]] = True
            rank_x, rank_y = self.rank[x], self.rank[y]
            undo_x = rank_x > rank_y  # of two equal merges the right one came last
            undo_y = ~undo_x & (rank_y >= 0)
            taken_x, taken_y = np.where(undo_x, rank_x, taken_x), np.where(undo_y, rank_y, taken_y)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_y, self.left[y], y)
            go_on = (undo_x | undo_y) & ~found
            open_, x, y, taken_x, taken_y = open_[go_on], x[go_on], y[go_on], taken_x[go_on], taken_y[go_on]
        return bad

    def _find_whole(self, suffix: str) -> None:
        made = np.argsort(self.rank)[(self.rank < 0).sum() :]
        kept_apart = ~self.merged_across(self.left[made], self.right[made], but_last=True)
        self.whole = self.rank < 0
        for token, apart, a, b in zip(made.tolist(), kept_apart.tolist(), self.left[made].tolist(), self.right[made].tolist()):
            self.whole[token] = apart and self.whole[a] and self.whole[b]
        # A line break stands for the end of a word; as a byte it has another symbol.
        self.longest = ahocorasick.Automaton()
        self.width = np.zeros(self.size, dtype=np.int64)
        self.symbol, self.last_symbol = {}, {}
        for text, i in self.ids.items():
            ends = text.endswith(suffix) and text != suffix
            core = text[: -len(suffix)] if ends else text
            if self.rank[i] < 0 and len(core) == 1:
                (self.last_symbol if ends else self.symbol)[core] = i
            if self.whole[i] and (len(core) == 1 or self.rank[i] >= 0):
                self.longest.add_word(core + "\n" * ends, i)
                self.width[i] = len(core) + ends
        self.longest.make_automaton()
        self._symbol_at, self._last_symbol_at = np.zeros((2, 512), dtype=np.int64)
        for table, symbols in ((self._symbol_at, self.symbol), (self._last_symbol_at, self.last_symbol)):
            table[[ord(c) for c in symbols]] = list(symbols.values())

    def merge(self, word: str) -> list[int]:
        """The tokens of a word, given as byte symbols, by merging the lowest rank first."""
        tokens = [self.symbol[c] for c in word[:-1]] + [self.last_symbol[word[-1]]]
        after, before = list(range(1, len(tokens) + 1)), list(range(-1, len(tokens) - 1))
        merges, waiting = self.merges, []

        def offer(i: int, j: int) -> None:
            if found := merges.get((tokens[i], tokens[j])):
                heapq.heappush(waiting, (found[0], i, tokens[i], tokens[j], found[1]))

        for i in range(len(tokens) - 1):
            offer(i, i + 1)
        while waiting:
            _, i, a, b, made = heapq.heappop(waiting)
            j = after[i]
            if tokens[i] != a or j >= len(tokens) or tokens[j] != b:
                continue  # one of the two has been taken since
            tokens[i], tokens[j] = made, -1
            after[i] = after[j]
            if after[i] < len(tokens):
                before[after[i]] = i
                offer(i, after[i])
            if before[i] >= 0:
                offer(before[i], i)
        return [t for t in tokens if t >= 0]

    def merge_all(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``merge`` of many short words, each by its lowest rank in every round: the number of the
        word and the token, for all tokens."""
        ends = np.cumsum(lengths) - 1
        tokens = self._symbol_at[codes]
        tokens[ends] = self._last_symbol_at[codes[ends]]
        word = np.repeat(np.arange(len(lengths)), lengths)
        rank = np.full(len(tokens), NEVER)  # of a token and the next one
        inner = np.flatnonzero(word[1:] == word[:-1])
        rank[inner] = self.pair_ranks(tokens[inner], tokens[inner + 1])
        done = []
        while len(tokens):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            best = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(tokens)))
            live = best != NEVER
            if not live.all():
                done.append((word[~live], tokens[~live]))
                word, tokens, rank, best = word[live], tokens[live], rank[live], best[live]
            at = np.flatnonzero(rank == best)
            # In a row of equal tokens every second pair is merged, from the left.
            begins = np.concatenate(([True], np.diff(at) != 1))[: len(at)]
            at = at[(at - np.maximum.accumulate(np.where(begins, at, 0))) % 2 == 0]
            tokens[at] = self.made[rank[at]]
            left = np.ones(len(tokens), dtype=bool)
            left[at + 1] = False
            word, tokens, rank = word[left], tokens[left], rank[left]
            at = at - np.arange(len(at))
            for changed in (at, at[at > 0] - 1):
                next_ = np.minimum(changed + 1, len(tokens) - 1)
                joined = (next_ > changed) & (word[next_] == word[changed])
                rank[changed] = np.where(joined, self.pair_ranks(tokens[changed], tokens[next_]), NEVER)
        word, tokens = (np.concatenate(c) for c in zip(*done))
        order = np.argsort(word, kind="stable")
        return word[order], tokens[order]

    def encode_words(self, codes: np.ndarray, short: int = 64) -> tuple[np.ndarray, np.ndarray, int]:
        """The ids of words, given as byte symbols that end in line breaks: all ids, how many each
        word has, and how many words had to be merged."""
        ends = np.flatnonzero(codes == 10) + 1
        lengths = np.diff(ends, prepend=0)
        found = chain.from_iterable(self.longest.iter_long(codes.tobytes().decode("utf-32-le")))
        matches = np.fromiter(found, np.int64).reshape(-1, 2)
        word, tokens = np.searchsorted(ends, matches[:, 0], side="right"), matches[:, 1]
        failed = np.bincount(word, self.width[tokens], minlength=len(ends)) != lengths
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, which = np.unique(tokens[inner] * self.size + tokens[inner + 1], return_inverse=True)
        wrong = self.merged_across(pairs // self.size, pairs % self.size)[which]
        failed[word[inner[wrong]]] = True
        good = ~failed[word]
        parts = [(word[good], tokens[good])]
        few, long = np.flatnonzero(failed & (lengths <= short)), np.flatnonzero(failed & (lengths > short))
        if len(few):
            own, _ = _gather(codes, lengths, few)
            which, merged = self.merge_all(own[own != 10], lengths[few] - 1)
            parts.append((few[which], merged))
        for i in long.tolist():
            merged = self.merge(codes[ends[i] - lengths[i] : ends[i] - 1].tobytes().decode("utf-32-le"))
            parts.append((np.full(len(merged), i), np.array(merged, dtype=np.int64)))
        word, tokens = (np.concatenate(c) for c in zip(*parts))
        tokens = tokens[np.argsort(word, kind="stable")].astype("<u4")
        return tokens, np.bincount(word, minlength=len(ends)), len(few) + len(long)


class Encoder:
    """Ids of texts. The different words of many texts are looked up, new ones guessed and checked.

    ``added`` says whether added tokens in a text become their one id, or are spelled out. Words hold
    no white space; a line break marks those that stand for an id, and pieces given as byte symbols.
    """

    def __init__(self, path: str, remembered: int = 300_000, added: bool = True):
        self.vocabulary = Vocabulary(path)
        self.marks = self.vocabulary.added if added else {}
        self.normalise = self.vocabulary.tokenizer.normalizer.normalize_str
        self.split_odd = self.vocabulary.tokenizer.pre_tokenizer.pre_tokenize_str
        self.remembered, self.merged = remembered, 0
        #: Words, their ids end to end, how many each has, and which were asked for of late.
        self.known, self.table = pa.array([], pa.large_string()), np.zeros(0, dtype="<u4")
        self.lengths, self.used = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
        ends = np.frombuffer(".\n,\n".encode("utf-32-le"), "<u4")
        self.stops, self.stop_lengths, _ = self.vocabulary.encode_words(ends)

    def _odd(self, text: str) -> bool:
        """Whether lower-casing letter by letter and splitting at white space is not enough."""
        return beyond_latin(text) or any(c in text for c in SEPARATORS) or any(mark in text for mark in self.marks)

    def _odd_words(self, text: str) -> list[str]:
        found, at = [], 0
        for mark in re.finditer("|".join(map(re.escape, self.marks)) or "(?!)", text):
            found += [*self.normalise(text[at : mark.start()]).split(" "), f"\n{self.marks[mark.group()]}"]
            at = mark.end()
        return found + self.normalise(text[at:]).split(" ")

    def _split(self, texts: list[str]) -> tuple[np.ndarray, pa.Array]:
        """How many words each text has, and all of them."""
        odd = [self._odd(text) for text in texts]
        plain = pc.utf8_split_whitespace(pc.utf8_lower(pa.array(["" if o else t for t, o in zip(texts, odd)], pa.large_string())))
        if not any(odd):
            return pc.list_value_length(plain).to_numpy(zero_copy_only=False), plain.flatten()
        strange = pa.array([self._odd_words(t) if o else None for t, o in zip(texts, odd)], plain.type)
        words = pc.if_else(pa.array(odd), strange, plain)
        return pc.list_value_length(words).to_numpy(zero_copy_only=False), words.flatten()

    def _pieces(self, word: str) -> bytes:
        """The parts of a word that are encoded on their own, each as bytes with a line break."""
        if beyond_latin(word):
            backwards = self.vocabulary.byte_of
            parts = [bytes(map(backwards.__getitem__, shown)) for shown, _ in self.split_odd(word)]
        else:
            parts = [p.encode() for p in PIECE.findall(word)]
        return b"".join(p + b"\n" for p in parts)

    def _learn(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of new words end to end, and how many each has."""
        simple = pc.and_(pc.utf8_is_alpha(words), pc.invert(pc.match_substring_regex(words, BEYOND_LATIN.pattern)))
        simple = simple.to_numpy(zero_copy_only=False)
        plain = words.filter(pa.array(simple))
        lines = pc.binary_join_element_wise(plain, *(pa.scalar(x, pa.large_string()) for x in ("", "\n")))
        joined = lines.buffers()[2].to_pybytes()[: pc.sum(pc.binary_length(lines)).as_py()] if len(plain) else b""
        rest = words.filter(pa.array(~simple)).to_pylist()
        pieces = [b"" if w[:1] == "\n" else self._pieces(w) for w in rest]
        ids, counts, merged = self.vocabulary.encode_words(self.vocabulary.show(joined + b"".join(pieces)))
        self.merged += merged
        given = [i for i, w in enumerate(rest) if w[:1] == "\n"]
        table = np.concatenate([ids, np.array([int(rest[i]) for i in given], dtype="<u4")])
        several = np.array([p.count(b"\n") for p in pieces], dtype=np.int64)
        per_word = np.bincount(np.repeat(np.arange(len(rest)), several), counts[len(plain) :], minlength=len(rest)).astype(np.int64)
        # In the table stand the simple words, the others, and the ids that words stand for.
        lengths = np.concatenate([counts[: len(plain)], per_word, np.ones(len(given), dtype=np.int64)])
        places = np.empty(len(words), dtype=np.int64)
        places[simple] = np.arange(len(plain))
        others = len(plain) + np.arange(len(rest))
        others[given] = len(plain) + len(rest) + np.arange(len(given))
        places[~simple] = others
        return _gather(table, lengths, places)[0], lengths[places]

    def _look_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of different words end to end, and how many each has."""
        at = pc.fill_null(pc.index_in(words, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        missing = at < 0
        if missing.any():
            new = words.filter(pa.array(missing))
            at[missing] = len(self.known) + np.arange(len(new))
            table, lengths = self._learn(new)
            self.known = pa.concat_arrays([self.known, new])
            self.table, self.lengths = np.concatenate([self.table, table]), np.concatenate([self.lengths, lengths])
            self.used = np.concatenate([self.used, np.ones(len(new), dtype=bool)])
        self.used[at] = True
        found = _gather(self.table, self.lengths, at)[0], self.lengths[at]
        if len(self.known) > self.remembered:
            self._forget(at)
        return found

    def _forget(self, latest: np.ndarray) -> None:
        """Keep the words that were used since the last time, or only the latest if those are too many."""
        if self.used.sum() > self.remembered // 2:
            self.used[:] = False
            self.used[latest] = True
        kept = np.flatnonzero(self.used)
        self.known = self.known.take(pa.array(kept))
        self.table, self.lengths = _gather(self.table, self.lengths, kept)[0], self.lengths[kept]
        self.used = np.zeros(len(kept), dtype=bool)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, as 32-bit numbers, and where each text starts and ends."""
        counts, words = self._split(texts)
        coded = words.dictionary_encode()
        different = coded.dictionary
        # A full stop or comma after letters is a piece of its own.
        cores = pc.utf8_rtrim(different, ".,")
        ended = pc.and_(pc.utf8_is_alpha(cores), pc.equal(pc.subtract(pc.binary_length(different), pc.binary_length(cores)), 1))
        ended = pc.and_(ended, pc.invert(pc.match_substring_regex(different, BEYOND_LATIN.pattern)))
        keys = pc.if_else(ended, cores, different).dictionary_encode()
        table, lengths = self._look_up(keys.dictionary)
        none = len(lengths) + 2
        stop = np.where(pc.ends_with(different, ".").to_numpy(zero_copy_only=False), none - 2, none - 1)
        stop = np.where(ended.to_numpy(zero_copy_only=False), stop, none)
        both = np.stack([keys.indices.to_numpy(zero_copy_only=False), stop], axis=1).ravel()
        table, ends = _gather(np.concatenate([table, self.stops]), np.concatenate([lengths, self.stop_lengths, [0]]), both)
        ids, ends = _gather(table, np.diff(ends[1::2], prepend=0), coded.indices.to_numpy(zero_copy_only=False))
        return ids, np.concatenate(([0], ends))[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        ids, edges = self.encode_all(texts)
        joined, edges = ids.tobytes(), (edges * 4).tolist()
        return [joined[a:b] for a, b in zip(edges, edges[1:])]


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """One per Python worker; later tasks find its memory filled."""
    return Encoder(path)


class Decoder:
    """Texts of ids: tokens joined by single spaces, as the library does without a decoder."""

    def __init__(self, texts: list[str]):
        written = [text.encode() + b" " for text in texts]
        self.bytes = np.frombuffer(b"".join(written), np.uint8)
        self.widths = np.array([len(w) for w in written], dtype=np.int64)
        self.starts = np.cumsum(self.widths) - self.widths

    def decode(self, offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
        """``offsets`` are where the ids of each text start, and the end."""
        widths = self.widths[ids]
        filled = np.flatnonzero(np.diff(offsets))
        widths[offsets[filled + 1] - 1] -= 1  # no space after the last token
        stops = np.cumsum(widths)
        places = np.repeat(self.starts[ids] - (stops - widths), widths)
        places += np.arange(len(places))
        ends = np.concatenate(([0], stops))[offsets]
        return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(self.bytes[places]))


@lru_cache(maxsize=1)
def decoder(path: str) -> Decoder:
    return Decoder(Vocabulary(path).texts)


def text_sizes(texts: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def parts_of(batch: pa.RecordBatch, sizes: np.ndarray, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` in size, so that memory follows neither rows nor lengths."""
    block = np.cumsum(sizes) // most
    edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges[:-1], edges[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _with_column(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def _replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    kept = [n for n in batch.schema.names if n != name]
    return pa.RecordBatch.from_arrays([*[batch.column(n) for n in kept], values], [*kept, name])


def encode(docs: DataFrame, path: str, column: str = "text", into: str = "ids", size: int = 1 << 22) -> DataFrame:
    """``docs`` with the ids of a text column as ``array<int>``."""
    schema = _with_column(docs, into, T.ArrayType(T.IntegerType(), False))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for part in parts_of(batch, text_sizes(batch.column(column)), size):
                ids, edges = own.encode_all([t or "" for t in part.column(column).to_pylist()])
                yield _replaced(part, into, pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.view("<i4"))))

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, column: str = "ids", into: str = "decoded", ids: int = 1 << 20) -> DataFrame:
    """``encoded`` with the text of a column of ids; NULL ids and NULL arrays give an empty text."""
    schema = _with_column(encoded, into, T.StringType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = decoder(path)
        for batch in batches:
            sizes = pc.list_value_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
            for part in parts_of(batch, sizes.astype(np.int64), ids):
                lists = part.column(column)
                lengths = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
                offsets = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
                flat = lists.flatten()
                if flat.null_count:
                    raise ValueError("ids hold NULL")
                texts = own.decode(offsets, flat.to_numpy(zero_copy_only=False))
                yield _replaced(part, into, texts.cast(pa.string()))

    return encoded.mapInArrow(run, schema)
