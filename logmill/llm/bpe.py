"""Splitting and byte-pair encoding with the files of public tokenizers. Paths are parameters; nothing is trained here."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np

# The code points with the Unicode property White_Space.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200, 8201, 8202, 8232, 8233, 8239, 8287, 12288)
OTHER, SPACE, LETTER, NUMBER, UNASSIGNED = 0, 1, 2, 3, 4


def _class_of(cp: int) -> int:
    if cp in WHITE_SPACE:
        return SPACE
    kind = unicodedata.category(chr(cp))
    return UNASSIGNED if kind == "Cn" else {"L": LETTER, "N": NUMBER}.get(kind[0], OTHER)


@lru_cache(1 << 14)
def _library_class(path: str, cp: int) -> int:
    """The class that the tokenizer of ``path`` (byte-level) gives a code point: whether it joins a letter, a digit, a full stop or none."""
    pieces = library(path).pre_tokenizer.pre_tokenize_str
    return next((kind for kind, before in ((LETTER, "a"), (NUMBER, "1"), (OTHER, ".")) if len(pieces(before + chr(cp))) == 1), SPACE)


@lru_cache(1)
def unassigned():
    """Search for a code point that Python's Unicode tables do not know; a library with newer tables may."""
    known = np.array([unicodedata.category(chr(c)) != "Cn" for c in range(0x110000)])
    edges = np.flatnonzero(np.diff(np.concatenate([[True], known, [True]]).astype(np.int8)))
    return re.compile("[" + "".join(f"{re.escape(chr(a))}-{re.escape(chr(b - 1))}" for a, b in edges.reshape(-1, 2).tolist()) + "]").search


@lru_cache(1)
def _bmp_classes() -> np.ndarray:
    return np.fromiter(map(_class_of, range(0x10000)), np.uint8, 0x10000)


def classes(cps: np.ndarray, path: str | None = None) -> np.ndarray:
    """OTHER, SPACE, LETTER or NUMBER of each code point; what Python's tables do not know is asked of the tokenizer in ``path``, if given."""
    table = _bmp_classes()
    out = table[np.minimum(cps, 0xFFFF)]
    if len(high := np.flatnonzero(cps > 0xFFFF)):
        values, where = np.unique(cps[high], return_inverse=True)
        out[high] = np.fromiter(map(_class_of, values.tolist()), np.uint8, len(values))[where]
    if len(new := np.flatnonzero(out == UNASSIGNED)):
        values, where = np.unique(cps[new], return_inverse=True)
        out[new] = np.array([_library_class(path, c) if path else OTHER for c in values.tolist()], np.uint8)[where]
    return out


@lru_cache(1)
def byte_chars() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: itself if it is printable, else the next free one from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, free = [""] * 256, 256
    for b in range(256):
        if b in printable:
            out[b] = chr(b)
        else:
            out[b], free = chr(free), free + 1
    return out


# ---- Pre-tokens of byte-level BPE, for many texts at once --------------------------------------------------------------------------


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All texts' code points in one array, and where each text starts (one entry more than texts)."""
    ends = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=ends[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), ends


def byte_level_starts(cps: np.ndarray, bounds: np.ndarray, path: str | None = None) -> np.ndarray:
    """Where the pre-tokens start: contractions, runs of letters, of numbers or of others with one space before, runs of white space.

    A run of white space gives its last character away if something follows: a plain space to the run behind it, another one as a
    pre-token of its own. ``bounds``: where the texts start; no pre-token crosses them.
    """
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    kind = classes(cps, path)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    edge[n] = True
    first = edge[:-1].copy()
    first[1:] |= kind[1:] != kind[:-1]  # of a run
    start = first.copy()
    ends_run = np.append(first[1:], True)
    gives = np.flatnonzero((kind == SPACE) & ends_run & ~edge[1:])  # the last white space before something
    start[gives] = True
    start[gives[cps[gives] == 32] + 1] = False
    quote = np.flatnonzero((cps == 39) & start & ends_run & ~edge[1:])
    quote = quote[kind[quote + 1] == LETTER]
    if len(quote):
        a, b = cps[quote + 1], cps[np.minimum(quote + 2, n - 1)]
        more = (quote + 2 < n) & ~edge[np.minimum(quote + 2, n)]
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = more & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        for at, k in ((quote[one], 2), (quote[two & ~one], 3)):
            start[at + 1] = False
            behind = at + k
            behind = behind[behind < n]
            cut = behind[~edge[behind] & (kind[behind] == LETTER)]
            start[cut] = True
    return np.flatnonzero(start)


@lru_cache(1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number modulo 2**64 and of its inverse."""
    base, n = 0x9E3779B97F4A7C15, 1 << 21
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.ones(n, np.uint64)
        p[1:] = b
        out.append(np.cumprod(p))
    return out[0], out[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span [start, end) of ``values``: differences of prefix sums of a polynomial."""
    pw, inv = _powers()
    sums = np.zeros(len(values) + 1, np.uint64)
    width = len(pw)
    total, shift = np.uint64(0), 1
    for a in range(0, len(values), width):
        part = values[a : a + width].astype(np.uint64) + np.uint64(1)
        np.cumsum(part * pw[: len(part)] * np.uint64(shift), out=sums[a + 1 : a + 1 + len(part)])
        sums[a + 1 : a + 1 + len(part)] += total
        total = sums[a + len(part)]
        shift = shift * pow(int(pw[1]), width, 1 << 64) % (1 << 64)
    down = inv[starts % width]
    if len(values) > width:
        step = pow(int(inv[1]), width, 1 << 64)
        table = np.array([pow(step, k, 1 << 64) for k in range(len(values) // width + 1)], np.uint64)
        down = down * table[starts // width]
    return mixed((sums[ends] - sums[starts]) * down + (ends - starts).astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def word_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span [start, end) of ``values``: a sum over mixed pairs of place and value, which no structure of the
    values can undo as it can with a polynomial. The cost is that of the spans' lengths, so they should not overlap much."""
    n = ends - starts
    stop = np.cumsum(n)
    k = np.arange(int(stop[-1]) if len(stop) else 0) - np.repeat(stop - n, n)
    sums = np.zeros(len(k) + 1, np.uint64)
    np.cumsum(mixed(values[np.repeat(starts, n) + k].astype(np.uint64) << np.uint64(32) | (k + 1).astype(np.uint64)), out=sums[1:])
    return mixed(sums[stop] - sums[stop - n] + n.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03))


def equal_spans(a: np.ndarray, a_start: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_start: np.ndarray, b_end: np.ndarray) -> np.ndarray:
    """Whether each span of ``a`` holds the same values as the span of ``b`` at its place."""
    n = a_end - a_start
    out = n == b_end - b_start
    n = np.where(out, n, 0)
    stop = np.cumsum(n)
    k = np.arange(int(stop[-1]) if len(stop) else 0) - np.repeat(stop - n, n)
    wrong = np.flatnonzero(a[np.repeat(a_start, n) + k] != b[np.repeat(b_start, n) + k])
    out[np.searchsorted(stop, wrong, "right")] = False
    return out


def distinct_spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, at, kind): of the distinct spans the hash and the place of one of them, by rising hash, and of each span its number there.

    Hashes only group; the values decide. Where unequal spans share a hash, all spans are told apart by their bytes.
    """
    found = span_hashes(values, starts, ends)
    hashes, at, kind = np.unique(found, return_index=True, return_inverse=True)
    if not equal_spans(values, starts, ends, values, starts[at[kind]], ends[at[kind]]).all():
        seen: dict[tuple[int, bytes], int] = {}
        kind = np.array([seen.setdefault((h, values[s:e].tobytes()), len(seen)) for h, s, e in zip(found.tolist(), starts.tolist(), ends.tolist(), strict=True)], np.int64)
        _, at = np.unique(kind, return_index=True)
        order = np.argsort(found[at], kind="stable")
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        at, kind = at[order], back[kind]
        hashes = found[at]
    return hashes, at, kind


class Specials:
    """Splits a text at the strings of added tokens, as the tokenizers library does by default."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.ids = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        self.pattern = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.ids, key=len, reverse=True)) + ")") if self.ids else None

    def split(self, text: str) -> list[str]:
        """Plain parts at even places, added tokens at odd ones."""
        return self.pattern.split(text) if self.pattern else [text]


@lru_cache(4)
def specials(path: str) -> Specials:
    return Specials(path)


@lru_cache(4)
def library(path: str, plain: bool = False):
    """The tokenizer of a .json file in the tokenizers library, for one thread; with ``plain`` the strings of special tokens are ordinary text."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    found.encode_special_tokens = plain
    return found


LONG_RUN = 10_000  # characters of white space in a row


@lru_cache(4)
def fast_encoder(path: str, plain: bool = False):
    """text -> ids of the byte-level BPE in ``path``, equal to the tokenizers library's, computed by tiktoken from the same file. With ``plain``
    the strings of special tokens are ordinary text.

    tiktoken takes ids as merge ranks; that holds if the merges of the file stand in the order of their products' ids, which is checked
    here. Texts with runs of white space that its pattern cannot take, and any on which it gives up, go to the tokenizers library.
    """
    import public_tokenizers
    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    back = {c: b for b, c in enumerate(byte_chars())}
    ranks = {bytes(back[c] for c in token): i for token, i in model["vocab"].items()}
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    made = [model["vocab"][a + b] for a, b in pairs]
    if made != sorted(made):
        raise ValueError(f"{path}: merges are not in the order of ids")
    extra = {} if plain else specials(path).ids
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=extra)
    names = set(extra)
    long_run = re.compile(rf"\s{{{LONG_RUN}}}").search

    def encode(text: str) -> list[int]:
        if len(text) >= LONG_RUN and long_run(text):
            return library(path, plain).encode(text, add_special_tokens=False).ids
        try:
            return encoding.encode(text, allowed_special=names, disallowed_special=()) if any(s in text for s in names) else encoding.encode_ordinary(text)
        except BaseException as e:
            if type(e).__name__ != "PanicException":  # of its native code; no subclass of Exception
                raise
            return library(path, plain).encode(text, add_special_tokens=False).ids

    return encode


# ---- Word-level BPE by forced boundaries -------------------------------------------------------------------------------------------


class ForcedBoundaryBpe:
    """BPE with word ends, computed on fragments between forced boundaries.

    If two neighbouring units (bytes, the last one of a word with its end mark) stand side by side inside no token of the vocabulary, no
    merge can ever join across them: there the word is cut for certain, and the fragments are encoded independently.
    """

    LIMIT = 400_000  # words and fragments remembered; then a memory is emptied
    LONGEST = 64  # characters of those, which bounds their bytes; longer ones are encoded each time

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.path, self.end = path, model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.chars = byte_chars()
        self.joined = {pair for token in self.vocab for u in [self._units(token)] for pair in zip(u, u[1:], strict=False)}
        self.specials = specials(path)
        self.tokens = [""] * (max([*self.vocab.values(), *self.specials.ids.values()]) + 1)
        for token, i in [*self.vocab.items(), *self.specials.ids.items()]:
            self.tokens[i] = token
        self.words: dict[str, list[int]] = {}
        self.fragments: dict[tuple[str, ...], list[int]] = {}
        narrow = range(0x250)
        letters, numbers, spaces = ("".join(re.escape(chr(c)) for c in narrow if _class_of(c) == k) for k in (LETTER, NUMBER, SPACE))
        contractions = "'s|'t|'re|'ve|'m|'ll|'d"
        self.find_narrow = re.compile(f"{contractions}|[{letters}]+|[{numbers}]|[^{spaces}{letters}{numbers}]+").findall
        import regex

        self.find_wide = regex.compile(rf"{contractions}|\p{{L}}+|\p{{N}}|[^ \p{{L}}\p{{N}}]+").findall
        self.wide = re.compile("[^\x00-ɏ]").search

    def _units(self, token: str) -> list[str]:
        body = token[: -len(self.end)] if token.endswith(self.end) and token != self.end else token
        units = list(body)
        if body is not token and len(body) < len(token):
            units[-1] += self.end
        return units

    def fragments_of(self, word: str) -> list[tuple[str, ...]]:
        units = [self.chars[b] for b in word.encode("utf-8")]
        units[-1] += self.end
        cuts = [0, *(i for i in range(1, len(units)) if (units[i - 1], units[i]) not in self.joined), len(units)]
        return [tuple(units[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def merge(self, units: tuple[str, ...]) -> list[int]:
        """The lowest-ranked pair is merged, the first of them first, until no pair is a merge."""
        parts = list(units)
        none = len(self.ranks)
        get = self.ranks.get
        while len(parts) > 1:
            rank, at = min((get(p, none), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == none:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.vocab[p] for p in parts]

    def word(self, word: str) -> list[int]:
        out: list[int] = []
        for f in self.fragments_of(word):
            ids = self.fragments.get(f)
            if ids is None:
                if len(self.fragments) >= self.LIMIT:
                    self.fragments.clear()
                ids = self.merge(f) if len(f) <= 200 else self.merge_long(f)
                if len(f) <= self.LONGEST:
                    self.fragments[f] = ids
            out += ids
        if len(self.words) >= self.LIMIT:
            self.words.clear()
        if len(word) <= self.LONGEST:
            self.words[word] = out
        return out

    def merge_long(self, units: tuple[str, ...]) -> list[int]:
        """As ``merge``, with a heap over a linked list, for fragments of any length."""
        import heapq

        parts: list[str | None] = list(units)
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        get = self.ranks.get
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(len(parts) - 1) if (r := get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j < 0 or parts[j] != b:
                continue
            parts[i], parts[j], after[i] = a + b, None, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0 and (r := get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [self.vocab[p] for p in parts if p is not None]

    def pre_tokens(self, text: str) -> list[str]:
        low = text.lower()
        if text.isascii() or not (self.wide(text) or self.wide(low)):  # some narrow capitals have wide small letters, and the reverse
            return self.find_narrow(low)
        plain = library(self.path).normalizer.normalize_str(text)
        if unassigned()(plain):
            return [plain[a:b] for _, (a, b) in library(self.path).pre_tokenizer.pre_tokenize_str(plain)]
        return self.find_wide(plain)

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known, new = self.words, self.word
        for k, part in enumerate(self.specials.split(text)):
            if k % 2:
                out.append(self.specials.ids[part])
            else:
                for w in self.pre_tokens(part):
                    ids = known.get(w)
                    out += new(w) if ids is None else ids
        return out

    def decode(self, ids: list[int]) -> str:
        """The file has no decoder: tokens stand with a space between."""
        return " ".join(map(self.tokens.__getitem__, ids))


@lru_cache(2)
def forced_boundary_bpe(path: str) -> ForcedBoundaryBpe:
    return ForcedBoundaryBpe(path)
