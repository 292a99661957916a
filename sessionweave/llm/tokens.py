"""Token ids of a public byte-level BPE vocabulary, as the tokenizers library gives them."""

from __future__ import annotations

import json

import numpy as np

#: White space after a space: there, words are not encoded apart.
AFTER_SPACE = [" " + c for c in map(chr, range(0x3001)) if c.isspace()]
#: Distinct words kept by a worker, and the longest that is kept.
WORDS, LONGEST = 700_000, 64


def byte_symbols() -> dict[str, int]:
    """The printable symbol of each byte in byte-level vocabularies: printable bytes stand for themselves, others follow from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Encoder:
    """Text to little-endian 32-bit ids.

    Words are split at single spaces, before which the vocabulary's pattern
    always cuts, and their ids are kept; so most of a corpus costs a lookup a
    word.  Texts with white space after a space, or very long words, are
    encoded whole.
    Merges are applied by tiktoken, with ranks taken from the same file, where
    the file's merges are in the order of their ids; texts that hold the string
    of an added token, and files of other kinds, go through tokenizers itself.
    """

    def __init__(self, file: bytes):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(file.decode())
        told = json.loads(file)
        self.added = [t["content"] for t in told.get("added_tokens", [])]
        self.fast = self._ranks(told)
        self.kept: dict[str, bytes] = {}
        if self.fast is not None:
            self.sizes = np.zeros(self.fast.max_token_value + 1, np.int64)
            for token in self.fast.token_byte_values():
                self.sizes[self.fast.encode_single_token(token)] = len(token)

    @staticmethod
    def _ranks(told: dict):
        pre, model = told.get("pre_tokenizer") or {}, told["model"]
        plain = (
            pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
            and not told.get("normalizer") and model.get("type") == "BPE" and not model.get("ignore_merges")
            and not model.get("dropout") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        )
        merges = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])]
        order = [model["vocab"].get(a + b, -1) for a, b in merges]
        if not plain or order != sorted(set(order)):
            return None
        import tiktoken

        symbols = byte_symbols()
        skip = {t["content"] for t in told.get("added_tokens", [])}
        ranks = {bytes(symbols[c] for c in t): k for t, k in model["vocab"].items() if t not in skip}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _ids(self, text: str) -> bytes:
        if self.fast is None or any(t in text for t in self.added):
            ids = self.whole.encode(text, add_special_tokens=False).ids
        else:
            ids = self.fast.encode_ordinary(text)
        return np.array(ids, "<u4").tobytes()

    def _learn(self, words: set[str]) -> None:
        """Ids of new words, encoded as one text and cut apart where the words end."""
        plain = [w for w in words if w == w.strip() and w]
        data = [(" " + w).encode() for w in plain]
        ids = np.array(self.fast.encode_ordinary(b"".join(data).decode()), "<u4")
        ends = np.searchsorted(np.cumsum(self.sizes[ids]), np.cumsum([len(d) for d in data])) + 1
        flat, starts = ids.tobytes(), np.append(0, ends[:-1])
        self.kept.update(zip(plain, (flat[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), strict=True))
        for w in words.difference(plain):
            self.kept[w] = self._ids(" " + w)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; words that are new are encoded once for the whole batch."""
        cut: list[list[str] | None] = []
        for text in texts:
            apart = self.fast is not None and not any(c in text for c in AFTER_SPACE) and not any(t in text for t in self.added)
            parts = text.split(" ") if apart else None
            # An empty part at an end is a space there; long parts are not worth keeping.
            whole = parts is None or not parts[0] or not parts[-1] or max(map(len, parts)) > LONGEST
            cut.append(None if whole else parts)
        new = set().union(*(parts[1:] for parts in cut if parts)).difference(self.kept)
        if new:
            if len(self.kept) + len(new) > WORDS:
                self.kept.clear()
                new = set().union(*(parts[1:] for parts in cut if parts))
            self._learn(new)
        get = self.kept.__getitem__
        return [
            self._ids(text) if parts is None else b"".join([self._ids(parts[0]), *map(get, parts[1:])])
            for text, parts in zip(texts, cut, strict=True)
        ]
