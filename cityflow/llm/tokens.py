"""Token ids of whole texts by a tokenizer file of the tokenizers library."""

from __future__ import annotations

from struct import pack

from cityflow.llm.pieces import ByteLevel, long_runs

END_ID = 0

_encoders: dict[str, Encoder] = {}


def default_tokenizer() -> str:
    """Path of the public byte-level vocabulary of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file, so its memory serves later tasks too."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    """Ids as little-endian unsigned 32-bit bytes, as `encode(add_special_tokens=False)` gives.

    Byte-level files are merged by tiktoken, several times as fast (`ByteLevel.ranked`). Texts
    with the string of a special token or with very long runs of visible or of blank
    characters, and those of other files, go to the library.
    """

    def __init__(self, path: str):
        self.library = ByteLevel(path)
        added = self.library.tokenizer.get_added_tokens_decoder().values()
        self.special = [t.content for t in added]

    def _plain(self, text: str) -> bool:
        return not any(s in text for s in self.special) and not long_runs(text)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text (null: empty), without an end id."""
        out, fast = [b""] * len(texts), self.library.ranked()
        rest = []
        for k, text in enumerate(texts):
            if text and fast and self._plain(text):
                out[k] = fast.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
            elif text:
                rest.append(k)
        for k, ids in zip(rest, self.library.whole([texts[k] for k in rest])):
            out[k] = pack(f"<{len(ids)}I", *ids)
        return out


def with_end(ids: bytes) -> bytes:
    return ids + END_ID.to_bytes(4, "little")
