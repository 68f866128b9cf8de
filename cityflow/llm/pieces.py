"""Texts cut at boundaries that no token crosses, for tokenizers of both libraries.

A space or line break that stands alone between two visible characters begins a new token
in a byte-level tokenizer, because its pattern takes white space only in front of a word,
and in a sentencepiece model none of whose pieces has a space or line break after another
character. What lies between two such boundaries is a piece; the tokens of a text are those
of its pieces one after the other. A piece is written without its leading space.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# White space of either library but the line break, for a class of a regular expression.
# Fixed values.
_OTHER = (
    "\\x09\\x0B-\\x0D\\x1C-\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}"
)
# A piece that is empty or whose ends touch white space, its own line break in front aside.
_UNSAFE = f"\\A\\n?\\z|\\A\\n?[{_OTHER}]|\\A\\n\\n|[{_OTHER}\\n]\\z"
_BOUNDARY = re.compile(r"(?<=\S)(?=[ \n]\S)")


def full(piece: str) -> str:
    """The characters a piece stands for."""
    return piece if piece[:1].isspace() else " " + piece


def cut(texts: pa.Array, mark: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces of a batch, the piece number of each occurrence, and where the
    occurrences of each text begin and end. `mark`, a space or a line break, is put before
    every text, so that its first piece is like any other."""
    marked = pc.replace_substring(texts, "\n", " \n")
    if mark == "\n":
        marked = pc.binary_join_element_wise("\n", marked, "")
    lists = pc.split_pattern(marked, " ")
    coded = lists.flatten().dictionary_encode()
    words = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    starts = lists.offsets.to_numpy()
    unsafe = pc.match_substring_regex(coded.dictionary, _UNSAFE).to_numpy(zero_copy_only=False)
    if not unsafe.any():
        return words, codes, starts
    # texts with wider white space are cut one by one
    odd = np.flatnonzero(np.logical_or.reduceat(unsafe[codes], starts[:-1]))
    number: dict[str, int] = {}
    parts, sizes, at = [], np.diff(starts), 0
    for row in odd:
        text = texts[int(row)].as_py()
        if mark == " ":
            found = _BOUNDARY.split(mark + text) if text else []
        elif text[:1].isspace() or not text:
            found = [mark, *(_BOUNDARY.split(text) if text else [])]
        else:
            found = _BOUNDARY.split(mark + text)
        own = [number.setdefault(p, len(words) + len(number)) for p in found]
        parts += [codes[at : starts[row]], np.array(own, codes.dtype)]
        sizes[row], at = len(own), starts[row + 1]
    parts.append(codes[at:])
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return words + list(number), np.concatenate(parts), ends


def byte_slices(texts: pa.Array, limit: int) -> Iterator[pa.Array]:
    """The texts in runs of about `limit` bytes; a longer one is a run of its own."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(ends):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield texts.slice(at, to - at)
        at = to


def runs(items: list[str], limit: int) -> Iterator[list[str]]:
    """The items in runs of about `limit` characters."""
    run, size = [], 0
    for item in items:
        if run and size + len(item) > limit:
            yield run
            run, size = [], 0
        run.append(item)
        size += len(item)
    if run:
        yield run


def stands_alone(words: list[str]) -> np.ndarray:
    """Which pieces begin and end at safe boundaries, so that they can stand in one text."""
    unsafe = pc.match_substring_regex(pa.array(words, pa.string()), _UNSAFE)
    return ~unsafe.to_numpy(zero_copy_only=False)


# Visible or blank characters in a row from which on tiktoken, whose time grows with the
# square of a run, is not used.
LONG_RUN = 2_000


def long_runs(text: str) -> bool:
    if len(text) < LONG_RUN:
        return False
    sizes = list(map(len, text.split()))
    blank = len(text) - sum(sizes)
    return max(sizes, default=0) >= LONG_RUN or blank >= len(sizes) + LONG_RUN


# Where a byte-level tokenizer parts words before merging. Fixed value.
_WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """A tokenizer file of the tokenizers library. `plain`: the strings of special tokens in
    a text are ordinary text; else they are found, as is the library's default."""

    mark = "\n"  # a text begins without a space

    def __init__(self, path: str, plain: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = plain
        self._ranked = False
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.cuts = (
            self.tokenizer.normalizer is None
            and "ByteLevel(add_prefix_space=False" in repr(self.tokenizer.pre_tokenizer)
            and "use_regex=True" in repr(self.tokenizer.pre_tokenizer)
            and not any(t.lstrip or t.rstrip or t.single_word or t.content.split() != [t.content]
                        for t in added)
        )

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(len, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)))

    def pieces(self, pieces: list[str]) -> list[list[int]]:
        return self.whole(list(map(full, pieces)))

    def piece_counts(self, pieces: list[str]) -> list[int]:
        return self.counts(list(map(full, pieces)))

    def joined(self, texts: list[str]) -> list[list[int]]:
        """As `whole`, by the faster merging of tiktoken where that is the file's rule; strings
        of special tokens are plain text."""
        if (fast := self.ranked()) is None:
            return self.whole(texts)
        return [
            self.whole([t])[0] if long_runs(t) else fast.encode_ordinary(t) for t in texts
        ]

    def ranked(self):
        """The vocabulary in tiktoken, which merges the pair of the lowest id first, if that is
        the order of the file's merges and nothing else bears on them; else None."""
        if self._ranked is False:
            self._ranked = self._by_rank()
        return self._ranked

    def _by_rank(self):
        model = json.loads(self.tokenizer.to_str())["model"]
        if not self.cuts or model["type"] != "BPE" or model.get("ignore_merges"):
            return None
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [model["vocab"]["".join(m)] for m in pairs]
        entries = self.token_bytes()
        single = {i for i, x in enumerate(entries) if len(x) == 1}
        if merged != sorted(merged) or len(merged) + len(single) < sum(map(bool, entries)):
            return None
        import tiktoken

        ranks = {x: i for i, x in enumerate(entries) if x}
        return tiktoken.Encoding("ranks", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})

    def token_bytes(self) -> list[bytes]:
        """What each id stands for: the entry's characters by the byte-level alphabet, in
        which visible Latin-1 characters are themselves and the other bytes follow U+0100."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        entries = self.tokenizer.get_vocab(with_added_tokens=False)
        out = [b""] * (max(entries.values(), default=-1) + 1)
        for entry, number in entries.items():
            out[number] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else b""
        return out


class SentencePieces:
    """A model file of the sentencepiece library."""

    mark = " "  # the model puts a space before a text

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = "ﬁ  x Å \n ｙ "
        self.cuts = self.model.normalize(probe) == "▁" + probe.replace(" ", "▁") and not any(
            "▁" in p.lstrip("▁") or "\n" in p for p in self.entries
        )

    def whole(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def counts(self, texts: list[str]) -> list[int]:
        return list(map(len, self.whole(texts)))

    def pieces(self, pieces: list[str]) -> list[list[int]]:
        # the model's own space before a line break is a token that the text does not have
        spaced = [p[1:] if p[:1] == " " else p for p in pieces]
        return [
            ids[1:] if p[:1] == "\n" else ids for p, ids in zip(pieces, self.whole(spaced))
        ]

    def piece_counts(self, pieces: list[str]) -> list[int]:
        return list(map(len, self.pieces(pieces)))

    def token_bytes(self) -> list[bytes]:
        return [
            bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.entries)
        ]


def library(path: str, plain: bool = False) -> ByteLevel | SentencePieces:
    """The reader of a file: sentencepiece for `.model`, else tokenizers."""
    return SentencePieces(path) if path.endswith(".model") else ByteLevel(path, plain)
