"""Exact byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece of text there is exactly one token that can be the last
one of the prefix's encoding. Candidates for it are the vocabulary entries that are
suffixes of the prefix (an automaton over all entries finds them in one pass); a
candidate is the right one if it may stand next to the last token of what precedes
it, which the vocabulary's merge table decides. The unique token is stored for each
prefix and the ids are read off by following the back-pointers. The cost is linear
in the length of the piece, also for pieces of many thousand letters.

The vocabulary is a byte-level one whose ids are merge ranks: 256 single bytes
first, then one id per merge in order.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from array import array

import ahocorasick

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"

#: Fixed values of the published pre-tokenizer: contractions, white space.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Exact on text without the characters of `_odd`.
FAST = re.compile(rf"{CONTRACTIONS}| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


class OddCharacter(Exception):
    """A piece holds a character on which FAST isn't known to be exact."""


def _odd() -> re.Pattern:
    """Numbers that aren't decimal digits, characters unassigned in this Python's
    tables (a newer standard may call them letters) and the four separators that
    Python, but not the tokenizer, takes for white space."""
    kinds = {"Nl", "No", "Cn"}
    ranges, start = ["\x1c-\x1f"], None
    for cp in range(0x80, sys.maxunicode + 2):
        odd = cp <= sys.maxunicode and unicodedata.category(chr(cp)) in kinds
        if odd and start is None:
            start = cp
        elif not odd and start is not None:
            ranges.append(f"{re.escape(chr(start))}-{re.escape(chr(cp - 1))}")
            start = None
    return re.compile(f"[{''.join(ranges)}]")


def _byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabulary files write bytes: printable bytes
    stand for themselves, the others follow from code point 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(rest)}


class PrefixEncoder:
    """Ids of one vocabulary; holds bounded caches of pieces and lines."""

    def __init__(self, path: str = VOCABULARY, cache_bytes: int = 96_000_000) -> None:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, vocabulary = _byte_letters(), model["vocab"]
        text = lambda token: bytes(letters[c] for c in token).decode("latin-1")
        pairs = [(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        self.single = {letters[t]: i for t, i in vocabulary.items() if len(t) == 1}
        self.first_merge = 256
        #: halves[id]: the two ids that the merge joins; a single byte's half is itself.
        self.halves = [(i, i) for i in range(self.first_merge)] + [(vocabulary[a], vocabulary[b]) for a, b in pairs]
        self.merged = {pair: self.first_merge + k for k, pair in enumerate(self.halves[self.first_merge :])}
        if any(vocabulary[a + b] != self.first_merge + k for k, (a, b) in enumerate(pairs)):
            raise ValueError("the ids of this vocabulary aren't its merge ranks")
        self.suffixes = ahocorasick.Automaton()
        special = {t for t, i in vocabulary.items() if i >= len(self.halves)}
        for token, i in vocabulary.items():
            if token not in special:
                self.suffixes.add_word(text(token), (i, len(text(token))))
        self.suffixes.make_automaton()
        self.odd = _odd()
        self.fits: dict[int, bool] = {}
        self.limit = cache_bytes
        self.lines: dict[str, bytes] = {}
        self.gaps: dict[str, bytes] = {}
        self.pieces = _Pieces(self)
        self.held = 0
        self._exact = None

    def adjacent(self, left: int, right: int) -> bool:
        """Whether the encoding of the joined text of two tokens is these two tokens.

        The last merges of both are undone in reverse order of rank; if, before a
        merge is undone, the two ids now at the border could have been merged earlier
        than that, the pair can't stand.
        """
        key = left * 65536 + right if right < 65536 else (left, right)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) > 1_000_000:
                self.fits.clear()
            known = self.fits[key] = self._adjacent(left, right)
        return known

    def _adjacent(self, left: int, right: int) -> bool:
        merged, halves = self.merged, self.halves
        before = len(halves)  # a merge across the border of a lower rank than this comes first
        while True:
            across = merged.get((left, right))
            if across is not None and across < before:
                return False
            open_left, open_right = left >= self.first_merge, right >= self.first_merge
            if open_left and (left > right or not open_right):
                before, left = left, halves[left][1]
            elif open_right:
                # of merges of equal rank the left one comes first, so one at the border still beats this one
                before, right = right + 1, halves[right][0]
            else:
                return True

    def encode_piece(self, piece: str) -> array:
        """Ids of a piece that the pre-tokenizer doesn't cut any further."""
        data = piece.encode("utf-8", "surrogatepass").decode("latin-1")
        last: list[int] = [0] * (len(data) + 1)
        back = [-1] * (len(data) + 1)
        adjacent = self.adjacent
        for end, (token, size) in self.suffixes.iter(data):
            end += 1
            if back[end] >= 0:
                continue
            start = end - size
            if start == 0 or (back[start] >= 0 and adjacent(last[start], token)):
                last[end], back[end] = token, start
        out, at = array("i"), len(data)
        if back[at] < 0 < at:
            # every byte is a token, so each prefix has an encoding unless the vocabulary lacks one
            raise ValueError(f"the vocabulary can't encode {piece!r}")
        while at > 0:
            out.append(last[at])
            at = back[at]
        out.reverse()
        return out

    def _cut_exactly(self, line: str) -> list[str]:
        """The published pre-tokenizer itself, for lines with odd characters."""
        if self._exact is None:
            from tokenizers.pre_tokenizers import ByteLevel

            self._exact = ByteLevel(add_prefix_space=False, use_regex=True)
        return [line[a:b] for _, (a, b) in self._exact.pre_tokenize_str(line)]

    def _line(self, line: str) -> bytes:
        known = self.lines.get(line)
        if known is None:
            pieces = self.pieces
            try:
                known = b"".join([pieces[p] for p in FAST.findall(line)])
            except OddCharacter:
                known = b"".join([self.encode_piece(p).tobytes() for p in self._cut_exactly(line)])
            if len(line) < 8192:
                self.lines[line] = known
                self.held += 2 * len(line) + len(known) + 160
                if self.held > self.limit:
                    self.lines.clear()
                    self.gaps.clear()
                    pieces.clear()
                    self.held = 0
        return known

    def _gap(self, gap: str) -> bytes:
        known = self.gaps.get(gap)
        if known is None:
            known = self.encode_piece(gap).tobytes()
            if len(gap) < 256:
                self.gaps[gap] = known
                self.held += 200
        return known

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids of a text as consecutive 4-byte integers; nothing for an empty or null text.

        The text is cut at its line ends first: no piece reaches from one line into
        the next, apart from the white space between them, of which all but the last
        character is one piece. Lines that occur again come from a cache.
        """
        if not text:
            return b""
        if "\n" not in text:
            return self._line(text)
        out: list[bytes] = []
        gap, started = "", False
        parts = text.split("\n")
        final = len(parts) - 1
        for i, part in enumerate(parts):
            core = part.strip(WHITE)
            if not core:
                gap += part if i == final else part + "\n"
                continue
            if core is not part and len(core) != len(part):
                lead = len(part) - len(part.lstrip(WHITE))
                gap += part[:lead]
                tail = part[lead + len(core) :]
            else:
                tail = ""
            if gap:
                # the last white space before a word joins it if it is a space, else stands alone
                if len(gap) > 1:
                    out.append(self._gap(gap[:-1]))
                if gap[-1] == " ":
                    core = " " + core
                else:
                    out.append(self._gap(gap[-1]))
            out.append(self._line(core))
            gap, started = (tail if i == final else tail + "\n"), True
        if gap:
            out.append(self._gap(gap))
        return b"".join(out)


class _Pieces(dict):
    """Piece -> ids as bytes; a missing piece is encoded on the way."""

    def __init__(self, encoder: PrefixEncoder) -> None:
        super().__init__()
        self.encoder = encoder

    def __missing__(self, piece: str) -> bytes:
        encoder = self.encoder
        if encoder.odd.search(piece):
            raise OddCharacter
        ids = encoder.encode_piece(piece).tobytes()
        if len(piece) < 512:
            self[piece] = ids
            encoder.held += 2 * len(piece) + len(ids) + 160
        return ids


_ENCODERS: dict[str, PrefixEncoder] = {}


def encoder(path: str = VOCABULARY) -> PrefixEncoder:
    """The process's encoder of a vocabulary; built once and kept by the Python worker."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PrefixEncoder(path)
    return _ENCODERS[path]
