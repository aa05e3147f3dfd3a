"""Token ids of text pieces, remembered per word, by a tokenizer file whose words are independent."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable
from unicodedata import normalize

import numpy as np

#: White space as the tokenizers' patterns take it.
SPACES = "\t-\r \x85\xa0  -     　"
#: Characters that ``str.split`` takes for white space and the patterns do not.
SEPARATORS = "\x1c\x1d\x1e\x1f"
#: Words remembered by a worker at most (about 120 MB); then it starts anew.
MEMORY_WORDS = 500_000
#: New words that the tokenizer gets in one text.
TOGETHER = 64
_segments = re.compile(f" ?[^{SPACES}]+|[{SPACES}]+(?![^{SPACES}])|[{SPACES}]+").findall


def open_tokenizer(content: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


#: Printable characters that stand for bytes in byte-level files, and for which.
PLAIN_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
WORD_END = "</w>"


def byte_values() -> dict[str, int]:
    """The byte for which each character of a byte-level file stands."""
    other = [b for b in range(256) if b not in set(PLAIN_BYTES)]
    return {chr(b): b for b in PLAIN_BYTES} | {chr(256 + i): b for i, b in enumerate(other)}


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of each id."""
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    values = byte_values()
    strings = [b""] * tokenizer.get_vocab_size(with_added_tokens=True)
    for token, i in tokenizer.get_vocab(with_added_tokens=True).items():
        plain = token.removesuffix(WORD_END)
        if token in special or any(c not in values for c in plain):
            strings[i] = token.encode()
        else:
            strings[i] = bytes(values[c] for c in plain)
    return strings


class Words:
    """Encodes texts as the tokenizer does, looking each distinct word up once.

    ``split`` cuts a text into words whose ids, put together, are the ids of the text, or gives
    None for a text that has to be encoded whole. New words go to the tokenizer many at a time,
    joined by ``glue``, and are told apart by their bytes; ``size`` counts those of a word, or
    gives None for one that has to be encoded alone. Where ``plain`` holds for joined words, each
    is as long as its characters.
    """

    def __init__(self, tokenizer, split, glue: str, size, plain=lambda joined: False):
        self.tokenizer, self.split, self.glue, self.size = tokenizer, split, glue, size
        self.plain = plain
        self.lengths = np.array([len(b) for b in token_bytes(tokenizer)], dtype=np.int64)
        self.known: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def learn(self, words: Iterable[str]) -> None:
        if len(self.known) > MEMORY_WORDS:
            self.known.clear()
        groups, other = [], []
        small = [w for w in words if w.isascii()]
        for at in range(0, len(small), TOGETHER):
            part = small[at : at + TOGETHER]
            if self.plain(joined := self.glue.join(part)):
                groups.append((part, joined, list(map(len, part))))
            else:
                other += part
        sized = []
        for word in [*other, *(w for w in words if not w.isascii())]:
            count = self.size(word)
            if count is None:
                self.known[word] = self.whole(word)
            else:
                sized.append((word, count))
        for at in range(0, len(sized), TOGETHER):
            part, counts = zip(*sized[at : at + TOGETHER], strict=True)
            groups.append((part, self.glue.join(part), counts))
        encoded = self.tokenizer.encode_batch_fast([g[1] for g in groups], add_special_tokens=False)
        for (part, _, counts), encoding in zip(groups, encoded, strict=True):
            ids = np.array(encoding.ids, dtype="<u4")
            ends = np.cumsum(self.lengths[ids])
            wanted = np.cumsum(counts)
            places = np.minimum(np.searchsorted(ends, wanted), len(ends) - 1)
            if not len(ends) or ends[-1] != wanted[-1] or (ends[places] != wanted).any():
                self.known.update((word, self.whole(word)) for word in part)
                continue
            data, cuts = ids.tobytes(), ((places + 1) * 4).tolist()
            pieces = [data[i:j] for i, j in zip([0, *cuts], cuts, strict=False)]
            self.known.update(zip(part, pieces, strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        return [np.frombuffer(ids, dtype="<u4") for ids in self.encode_bytes(texts)]

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        """As :meth:`encode`, as bytes."""
        get, out, late = self.known.get, [], []
        new: set[str] = set()
        for text in texts:
            words = self.split(text)
            if words is None:
                out.append(self.whole(text))
                continue
            found = list(map(get, words))
            if None in found:
                new.update(w for w, ids in zip(words, found, strict=True) if ids is None)
                late.append((len(out), words, found))
                out.append(b"")
            else:
                out.append(b"".join(found))
        if new:
            self.learn(new)
            for at, words, found in late:
                out[at] = b"".join(
                    get(w) if ids is None else ids for w, ids in zip(words, found, strict=True)
                )
        return out


def byte_words(tokenizer) -> Words:
    """For byte-level files whose pattern keeps one space before a word."""
    special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def split(text: str):
        if any(s in text for s in special):
            return None
        return _segments(text)

    def size(word: str) -> int | None:
        if word[0] != " " or word.isspace() or word[1] in SEPARATORS or word[-1] in SEPARATORS:
            return None
        return len(word) if word.isascii() else len(word.encode())

    return Words(tokenizer, split, "", size)


#: How the file of :class:`LatinWords` makes and cuts words.
_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Small letters of Latin scripts; they and their capitals are composed and made small one by one.
_SMALL = "a-z\xdf-\xf6\xf8-\u012f\u0131-\u017f"
_latin = re.compile("[\t-\r -~\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u017f\u2010-\u2027]*").fullmatch
_pieces = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_SMALL}]+|[0-9]|[^{_SMALL}0-9]+").findall


class _Known(dict):
    """Ids by word; ``learn`` makes those of a word that is missing."""

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.learn(word)
        return ids


class LatinWords(Words):
    """Makes texts of Latin letters, digits and signs small and cuts their words into the file's
    pieces by itself.

    Pieces go to the file's model and are remembered like words: they are fewer, as words differ in
    the signs around them, and none is normalized and cut by the tokenizer again. Texts with other
    characters take the way of :class:`Words`.
    """

    def __init__(self, *args):
        super().__init__(*args)
        self.known = _Known()
        self.known.learn = self.learn_latin
        self.model = self.tokenizer.model
        self.characters = {b: c for c, b in byte_values().items()}
        count = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.id_bytes = [i.to_bytes(4, "little") for i in range(count)]

    def learn_latin(self, word: str) -> bytes:
        if not word.isalpha() and len(pieces := _pieces(word)) > 1:
            return b"".join(map(self.known.__getitem__, pieces))
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(self.characters)
        return b"".join([self.id_bytes[t.id] for t in self.model.tokenize(word)])

    def encode_bytes(self, texts: list[str]) -> list[bytes]:
        out, other, get = [], [], self.known.__getitem__
        for at, text in enumerate(texts):
            if _latin(text) and "<|" not in text:
                if len(self.known) > MEMORY_WORDS:
                    self.known.clear()
                out.append(b"".join(map(get, text.lower().split())))
            else:
                other.append(at)
                out.append(b"")
        for at, ids in zip(other, super().encode_bytes([texts[i] for i in other]), strict=True):
            out[at] = ids
        return out


def _cuts_latin(tokenizer) -> bool:
    """Whether a file makes and cuts words as :class:`LatinWords` does."""
    state = lambda part: json.loads(part.__getstate__()) if part else {}
    cuts = state(tokenizer.pre_tokenizer).get("pretokenizers") or [{}, {}]
    return (
        state(tokenizer.normalizer).get("normalizers") == _NORMALIZERS
        and [c.get("type") for c in cuts] == ["Split", "ByteLevel"]
        and cuts[0]["pattern"] == {"Regex": _PIECES}
        and (cuts[0]["behavior"], cuts[0]["invert"]) == ("Removed", True)
        and not cuts[1]["add_prefix_space"]
        and not cuts[1]["use_regex"]
        and not tokenizer.model.dropout
        and not any(t.normalized or "<|" not in t.content for t in tokenizer.get_added_tokens_decoder().values())
    )


def spaced_words(tokenizer) -> Words:
    """For files that drop white space and make letters small."""

    def split(text: str):
        return None if any(c in text for c in SEPARATORS) else text.split()

    def size(word: str) -> int | None:
        if "<|" in word:
            return None  # a special string may be in it
        return len(word) if word.isascii() else len(normalize("NFC", word).lower().encode())

    kind = LatinWords if _cuts_latin(tokenizer) else Words
    return kind(tokenizer, split, " ", size, lambda joined: joined.isascii() and "<|" not in joined)
