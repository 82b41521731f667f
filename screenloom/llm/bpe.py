"""Byte-pair encoding by last-token states over a prefix-sharing trie; an encoder may be told to merge short words by rank side by side in arrays instead.

For every prefix of a word exactly one token can end its encoding: the suffix token that
stands unmerged beside the last token of what precedes it. Distinct words are visited in the
order of a trie's depth-first traversal (sorted order), and the states of the prefix that a
word shares with the one before it are kept, so a shared prefix is encoded once.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache
from struct import pack
from sys import getsizeof

import numpy as np

#: The letters and numbers below U+0250, and the two vocabularies' pre-token patterns over them.
LETTERS, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼½¾"
BYTE_PATTERN = re.compile(f" ?[{LETTERS}]+| ?[{NUMBERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\\s{LETTERS}{NUMBERS}]+|\\s+(?!\\S)|\\s+")
WORD_PATTERN = re.compile(f"[{LETTERS}]+|[{NUMBERS}]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{LETTERS}{NUMBERS}]+")
#: With any of these characters a text takes the library's own rules for case, composition and classes.
BEYOND = re.compile("[^\x00-\u024f]|[\x1c-\x1f\x85İ]")
SEPARATORS = "\x1c\x1d\x1e\x1f"
KEEP = 48 << 20  # bytes of encodings that an encoder remembers
MOST_PAIRS = 400_000  # of tokens that an encoder remembers, about 100 bytes each
ENTRY = 110  # bytes of a dictionary's entry beside its key and value
LONGEST = 64  # symbols of a word that merges in arrays, one merge a word and step: longer ones would take too many steps
NONE = np.iinfo(np.int32).max  # rank of two tokens that don't merge
SLOT_BITS = 18  # of the table of merges
END = 0x110000 // 2  # shifts a word's last symbol, to tell it from the same symbol inside


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def beyond(text: str) -> bool:
    """Whether BEYOND is found; an ASCII text can hold only the separators of it."""
    return any(map(text.__contains__, SEPARATORS)) if text.isascii() else BEYOND.search(text) is not None


class TrieEncoder:
    """Encoder of one vocabulary file; keeps encodings of distinct words of at most about `keep` bytes, and as many bytes of their sizes.

    Words of at most `short` bytes merge in arrays, all others go through the trie; with 0 every word does.
    """

    def __init__(self, path: str, keep: int = KEEP, short: int = LONGEST):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model.get("end_of_word_suffix") or ""
        self.path, self.suffix, self.keep, self.short = path, suffix, keep, short
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.normalized = spec["normalizer"] is not None
        self.split_special = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

        def inner(token: str) -> str:
            if suffix and token.endswith(suffix) and len(token) > len(suffix):
                token = token[: -len(suffix)]
                return token[:-1] + chr(ord(token[-1]) + END)
            return token

        self.ids = {inner(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.begins = {t[:n] for t in self.ids for n in range(1, len(t) + 1)}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.length = [0] * size
        for t, i in self.ids.items():
            self.length[i] = len(t)
        self.merges: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.rank = [-1] * size
        wholes = []  # what the merge of each rank makes
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = self.ids[inner(left)], self.ids[inner(right)], self.ids[inner(left + right)]
            self.merges.setdefault((a, b), rank)
            wholes.append(whole)
            if whole not in self.parts:
                self.parts[whole], self.rank[whole] = (a, b), rank
        self.bits = size.bit_length()  # a pair of tokens is the number left << bits | right
        self.from_byte = byte_alphabet()
        #: Of each byte, inside a word and at its end, -1 without a token.
        self.byte_ids, self.last_ids = (np.array([self.ids.get(chr(ord(self.from_byte[b]) + shift), -1) for b in range(256)], np.int32) for shift in (0, END if suffix else 0))
        self.whole = np.array(wholes, np.int32)
        self.slot_pair, self.slot_rank = np.full(1 << SLOT_BITS, -1, np.int64), np.full(1 << SLOT_BITS, NONE, np.int32)
        pairs, ranks = np.array([a << self.bits | b for a, b in self.merges], np.int64), np.array([*self.merges.values()], np.int32)
        at = self.slots(pairs)
        while len(pairs):  # the first of those that want a free slot takes it, the others try the next one
            free = np.flatnonzero(self.slot_pair[at] < 0)
            took = free[np.unique(at[free], return_index=True)[1]]
            self.slot_pair[at[took]], self.slot_rank[at[took]] = pairs[took], ranks[took]
            left = np.ones(len(pairs), bool)
            left[took] = False
            pairs, ranks, at = pairs[left], ranks[left], (at[left] + 1) % (1 << SLOT_BITS)
        self.beside: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.sizes: dict[str, int] = {}
        self.known_bytes = self.sizes_bytes = 0
        self._library = None

    @property
    def library(self):
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.path)
        return self._library

    def spine(self, token: int, side: int) -> list[tuple[int, int, float]]:
        """(part, rank that makes it, rank that uses it up) along one edge of a token's merge tree."""
        out, until = [], float("inf")
        while True:
            out.append((token, self.rank[token], until))
            if token not in self.parts:
                return out
            until, token = self.rank[token], self.parts[token][side]

    def stands(self, left: int, right: int) -> bool:
        """Whether encoding the text of left and right gives these two tokens.

        It does unless a merge across the border applies while both its parts exist; of equal
        ranks the leftmost merge goes first.
        """
        key = left << self.bits | right
        if (known := self.beside.get(key)) is not None:
            return known
        ok = True
        for a, a_from, a_until in self.spine(left, 1):
            for b, b_from, b_until in self.spine(right, 0):
                if b_from > a_until or a_from > b_until:
                    continue
                rank = self.merges.get((a, b))
                if rank is not None and max(a_from, b_from) < rank < a_until and rank <= b_until:
                    ok = False
        if len(self.beside) >= MOST_PAIRS:
            self.beside.clear()
        self.beside[key] = ok
        return ok

    @staticmethod
    def slots(pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank at which each two tokens merge, NONE for those that don't."""
        pairs = left.astype(np.int64) << self.bits | right
        at = self.slots(pairs)
        held = self.slot_pair[at]
        out = np.where(held == pairs, self.slot_rank[at], NONE)
        open_ = np.flatnonzero((held != pairs) & (held >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) % (1 << SLOT_BITS)
            held = self.slot_pair[at[open_]]
            hit = held == pairs[open_]
            out[open_[hit]] = self.slot_rank[at[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out

    def merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words (in UTF-8, none empty) in turn, and where each word's begin, with the end.

        At each step every word that still can makes its merge of lowest rank, the leftmost of equal ones, as BPE is defined.
        """
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        body, ends = np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - 1
        tokens = self.byte_ids[body]
        tokens[ends] = self.last_ids[body[ends]]
        if (tokens < 0).any():
            word = words[int(np.searchsorted(ends, np.flatnonzero(tokens < 0)[0]))].decode()
            raise ValueError(f"the vocabulary has no token for a symbol of {word!r}")
        names, lasts = np.arange(len(words)), np.cumsum(sizes) - 1
        rank = np.full(len(tokens), NONE, np.int32)  # of a token with the next one of its word
        if len(tokens) > 1:
            rank[:-1] = self.ranks(tokens[:-1], tokens[1:])
        rank[lasts] = NONE
        done_names, done_tokens = [], []
        while len(names):
            firsts = lasts - sizes + 1
            low = np.minimum.reduceat(rank, firsts)
            more = low < NONE
            if not more.all():
                stays = np.repeat(more, sizes)
                done_names.append(np.repeat(names[~more], sizes[~more]))
                done_tokens.append(tokens[~stays])
                tokens, rank, names, sizes, low = tokens[stays], rank[stays], names[more], sizes[more], low[more]
                if not len(names):
                    break
                lasts = np.cumsum(sizes) - 1
            of = np.repeat(np.arange(len(names)), sizes)
            hits = np.flatnonzero(rank == low[of])
            at = hits[np.unique(of[hits], return_index=True)[1]] if len(hits) > len(names) else hits
            tokens[at] = self.whole[low]
            stays = np.ones(len(tokens), bool)
            stays[at + 1] = False
            tokens, rank = tokens[stays], rank[stays]
            sizes = sizes - 1
            firsts, lasts, at = np.cumsum(sizes) - sizes, np.cumsum(sizes) - 1, at - np.arange(len(at))
            rank[at] = NONE
            inner = at[at < lasts]
            rank[inner] = self.ranks(tokens[inner], tokens[inner + 1])
            before = at[at > firsts] - 1
            rank[before] = self.ranks(tokens[before], tokens[before + 1])
        if not done_names:
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        names, tokens = np.concatenate(done_names), np.concatenate(done_tokens)
        return tokens[np.argsort(names, kind="stable")].astype("<u4"), np.concatenate([[0], np.cumsum(np.bincount(names, minlength=len(words)))])

    def encoded(self, pieces: list[str]) -> tuple[list[str], list[bytes]]:
        """These distinct pre-tokens, those that merge in arrays first, and the bytes of their ids."""
        long, made = pieces, []
        if self.short:
            words = list(map(str.encode, pieces))
            long = [p for p, w in zip(pieces, words) if len(w) > self.short]
            if long:
                pieces, words = [p for p, w in zip(pieces, words) if len(w) <= self.short], [w for w in words if len(w) <= self.short]
            ids, to = self.merged(words)
            held, to = ids.tobytes(), (4 * to).tolist()
            made = [held[a:b] for a, b in zip(to, to[1:])]
        else:
            pieces = []
        if long:
            named = list(map(self.symbols, long))
            codes = self.encode_words(named)
            made += [pack(f"<{len(codes[s])}I", *codes[s]) for s in named]
        return pieces + long, made

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Encode distinct words (in the vocabulary's symbols) in one traversal of their trie."""
        ids, length, stands, beside, begins, bits = self.ids.get, self.length, self.stands, self.beside.get, self.begins, self.bits
        out: dict[str, list[int]] = {}
        last: list[int] = [-1]  # last[n]: the last token of the prefix of n symbols
        lowest: list[int] = [0]  # lowest[n]: where the longest suffix of it starts that begins a token
        before = ""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del last[shared + 1 :], lowest[shared + 1 :]
            low = lowest[shared]
            for end in range(shared + 1, len(word) + 1):
                while low < end and word[low:end] not in begins:
                    low += 1
                lowest.append(low)
                state = -1
                for start in range(low, end):
                    token = ids(word[start:end])
                    if token is None:
                        continue
                    if start == 0:
                        state = token
                        break
                    previous = last[start]
                    if previous < 0:
                        continue
                    fits = beside(previous << bits | token)
                    if fits or fits is None and stands(previous, token):
                        state = token
                        break
                last.append(state)
            before, end, found = word, len(word), []
            while end > 0:
                token = last[end]
                if token < 0:
                    raise ValueError(f"the vocabulary has no token for a symbol of {word!r}")
                found.append(token)
                end -= length[token]
            out[word] = found[::-1]
        return out

    def symbols(self, piece: str) -> str:
        mapped = piece if piece.isalpha() and piece.isascii() else piece.encode().decode("latin-1").translate(self.from_byte)
        return mapped[:-1] + chr(ord(mapped[-1]) + END) if self.suffix else mapped

    def learn(self, pieces) -> None:
        """Have the ids of all these pre-tokens in self.known, each worked out once."""
        missing = set(pieces).difference(self.known)
        if not missing:
            return
        if self.known_bytes > self.keep:
            self.known.clear()
            self.known_bytes = 0
            missing = set(pieces)
        words, made = self.encoded(list(missing))
        self.known.update(zip(words, made))
        self.known_bytes += ENTRY * len(words) + sum(map(getsizeof, words)) + sum(map(getsizeof, made))

    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text without special strings."""
        if not self.normalized:
            if beyond(text):
                return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
            return BYTE_PATTERN.findall(text)
        lowered = text.lower()
        # asked of the small letters: some capitals below U+0250 have theirs beyond it, and the five capitals beyond it
        # whose small letter is below (U+1E9E, U+212A, U+212B, U+2C7E, U+2C7F) become the same by the library's rules
        if not beyond(lowered):
            return WORD_PATTERN.findall(lowered)
        text = self.library.normalizer.normalize_str(text)
        if beyond(text):
            return [text[a:b] for _, (a, b) in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return WORD_PATTERN.findall(text)

    def parsed(self, text: str) -> list[tuple[str | None, list[str]]]:
        """(special string or None, pre-tokens) in order."""
        if self.split_special is None or not self.split_special.search(text):
            return [(None, self.pieces(text))]
        return [(part, []) if part in self.special else (None, self.pieces(part)) for part in self.split_special.split(text) if part]

    def counts(self, pieces) -> dict[str, int]:
        """The number of tokens of each of these distinct pre-tokens, each worked out once."""
        missing = {p for p in pieces if p not in self.sizes}
        if missing:
            if self.sizes_bytes > self.keep:
                self.sizes.clear()
                self.sizes_bytes = 0
                missing = set(pieces)
            words, made = self.encoded(list(missing))
            self.sizes.update((p, len(ids) // 4) for p, ids in zip(words, made))
            self.sizes_bytes += sum(map(getsizeof, missing)) + ENTRY * len(missing)
        return self.sizes


@lru_cache(maxsize=2)
def encoder(path: str, keep: int = KEEP, short: int = LONGEST) -> TrieEncoder:
    """One encoder for each vocabulary and Python worker, which lives on with what it remembers while later stages run."""
    return TrieEncoder(path, keep, short)


def prepared(enc: TrieEncoder, texts: list[str | None], most: int = 1 << 20):
    """Yield (parsed texts) for runs of texts of about `most` characters, all their words learnt together."""
    run, size = [], 0
    for text in texts:
        run.append(enc.parsed(text or ""))
        size += len(text or "")
        if size >= most:
            enc.learn(set().union(*[ws for p in run for _, ws in p]))
            yield from run
            run, size = [], 0
    enc.learn(set().union(*[ws for p in run for _, ws in p]))
    yield from run


def ids_of(enc: TrieEncoder, parsed) -> bytes:
    known = enc.known
    return b"".join([b"".join(map(known.__getitem__, words)) if special is None else np.array([enc.special[special]], "<u4").tobytes() for special, words in parsed])


class Decoder:
    """Ids to text for one vocabulary file; holds the vocabulary alone."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        to_byte = {c: b for b, c in byte_alphabet().items()}
        vocab, special = spec["model"]["vocab"], {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of = [b""] * (max([*vocab.values(), *special.values()]) + 1)
        for token, i in vocab.items():
            if all(c in to_byte for c in token):
                self.bytes_of[i] = bytes(map(to_byte.__getitem__, token))
        for token, i in special.items():
            self.bytes_of[i] = token.encode()

    def text(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)
