"""BPE encoding and decoding equal to the tokenizers library, with tree concatenation for long unsplit text.

Ordinary words are looked up in a bounded per-worker memo and missed words go to the library's merge model. A word
of over `long_word` bytes is cut into leaves that are encoded as one parallel batch; neighbours are then joined level by
level, re-encoding a window around each join that grows until its first token agrees with the left side and its last
token with the right side. A sequence whose neighbouring pairs all stand as the merge model would put them is the
model's own output, so agreement on both ends makes the join exact.

Texts with characters beyond U+024F or with controls are normalised and split by the library; if they hold a long run
without blanks, their pieces are encoded here, long ones by tree concatenation, else all by the library. Texts with
special-token markers take the library's own route.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import struct

from pyspark.sql import DataFrame

from .common import give_back, lean

LONG_WORD = 32
LEAF = 16
MEMO_WORDS = 200_000
_PLAIN = re.compile("[^\t\n\r\x20-\x7e¡-ɏ]")
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def byte_chars() -> list[str]:
    """The printable character that byte-level BPE uses for each byte."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b if b in set(own) else next(spare)) for b in range(256)]


class WordBpe:
    """An encoder for one tokenizer file with word-end merges (lower case, white space dropped)."""

    def __init__(self, path: str, long_word: int = LONG_WORD, leaf: int = LEAF, memo_words: int = MEMO_WORDS):
        import numpy as np
        import regex

        spec = self._spec(path)
        self.path = path
        self.long_word, self.leaf, self.memo_words = long_word, leaf, memo_words
        model, split = spec["model"], (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])[0]
        self.markers = [t["content"] for t in spec["added_tokens"]]
        self.plain_layout = (spec["normalizer"] or {}).get("normalizers") == _NORMAL and split.get("type") == "Split" and split.get("invert") is True and model.get("end_of_word_suffix") == "</w>" and all("<|" in t for t in self.markers)
        self.words = regex.compile(split["pattern"]["Regex"]) if self.plain_layout else None
        size = max([*model["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.whole = self._merges(spec, {})
        self.chars = {i: c for i, c in enumerate(byte_chars())}
        self.model, self.code = self.whole.model, "H" if self.dtype.itemsize == 2 else "I"
        self.memo: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.missed = 0
        self.unsplit = re.compile(r"\S{%d}" % (long_word // 4 + 1))  # a character has four bytes at most

    @staticmethod
    def _spec(path: str) -> dict:
        with open(path, encoding="utf-8") as f:
            return json.load(f)

    @staticmethod
    def _merges(spec: dict, changes: dict):
        """The file's merge model alone, for text that is cut at blanks."""
        from tokenizers import Tokenizer

        lean = spec | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}, "post_processor": None, "decoder": None, "added_tokens": [], "model": spec["model"] | changes}
        return Tokenizer.from_str(json.dumps(lean))

    # What only some texts need is loaded when the first of them comes, since each copy of the vocabulary takes memory.

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(self.path)
        whole.no_padding()
        whole.no_truncation()
        return whole

    @functools.cached_property
    def inner(self):
        return self._merges(self._spec(self.path), {"end_of_word_suffix": None})

    @functools.cached_property
    def tokens(self) -> list[str]:
        spec = self._spec(self.path)
        by_id = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        return [by_id.get(i, "") for i in range(max(by_id) + 1)]

    @functools.cached_property
    def token_bytes(self) -> list[bytes]:
        return [t.encode() for t in self.tokens]

    @functools.cached_property
    def plain_text(self) -> list[str]:
        return [t.removesuffix("</w>") for t in self.tokens]

    def encode(self, text: str):
        """The ids of a whole text as an unsigned numpy array."""
        import numpy as np

        return np.frombuffer(self.encode_bytes(text), self.dtype)

    def encode_bytes(self, text: str) -> bytes:
        import numpy as np

        if self.plain_layout and "<|" not in text and _PLAIN.search(text) and self.unsplit.search(text):
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return b"".join([self.piece_bytes(p) for p, _ in cut])
        if not self.plain_layout or _PLAIN.search(text) or "<|" in text:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        chunks, memo = text.lower().split(), self.memo
        try:
            return b"".join([memo[c] for c in chunks])
        except KeyError:
            pass
        new = self.learn({c for c in chunks if c not in memo})
        out = b"".join([memo[c] if c in memo else new[c] for c in chunks])
        if len(memo) < self.memo_words:
            memo.update(new)
        else:  # frequent words came early and stay; a change of language shows as many misses
            self.missed += len(new)
            if self.missed > 4 * self.memo_words:
                self.memo, self.missed = {}, 0
        return out

    def learn(self, chunks: set[str]) -> dict[str, bytes]:
        """The ids of each chunk (text without white space)."""
        word, cut = self.word_bytes, self.words.findall
        return {c: word(c) if c.isalpha() else b"".join([word(p) for p in cut(c)]) for c in chunks}

    def pack(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def word_bytes(self, word: str) -> bytes:
        """The ids of one word as the pattern cuts them."""
        got = self.parts.get(word)
        if got is None:
            s = word if word.isascii() else word.encode().decode("latin-1").translate(self.chars)
            if len(s) > self.long_word:
                return self.join_leaves(s).tobytes()
            got = self.remember(word, s)
        return got

    def remember(self, key: str, s: str) -> bytes:
        if len(self.parts) > self.memo_words:
            self.parts = {}
        got = self.parts[key] = self.pack([t.id for t in self.model.tokenize(s)])
        return got

    def piece_bytes(self, s: str) -> bytes:
        """The ids of one word that is written in byte characters; long ones are joined from leaves."""
        if len(s) > self.long_word:
            return self.join_leaves(s).tobytes()
        key = f"\0{s}"  # no word has this character
        return self.parts.get(key) or self.remember(key, s)

    def _runs(self, texts: list[tuple[str, bool]]) -> list[list[int]]:
        """Encode strings of byte characters as one batch each way; True: the string ends its word."""
        out: list[list[int]] = [[]] * len(texts)
        for last, model in ((True, self.whole), (False, self.inner)):
            at = [i for i, t in enumerate(texts) if t[1] is last]
            if at:
                for i, e in zip(at, model.encode_batch_fast([texts[i][0] for i in at], add_special_tokens=False)):
                    out[i] = e.ids
        return out

    def encode_word(self, word: bytes):
        """Tree concatenation for one unsplit word."""
        return self.join_leaves(word.decode("latin-1").translate(self.chars))

    def join_leaves(self, s: str):
        import numpy as np

        leaves = [s[i : i + self.leaf] for i in range(0, len(s), self.leaf)]
        parts = self._runs([(x, i == len(leaves) - 1) for i, x in enumerate(leaves)])
        while len(parts) > 1:
            pairs = [[parts[i], parts[i + 1], 4, i + 2 == len(parts)] for i in range(0, len(parts) - 1, 2)]
            done: dict[int, list[int]] = {}
            while len(done) < len(pairs):  # one batch a round: every join that has not agreed yet
                todo = [i for i in range(len(pairs)) if i not in done]
                windows = []
                for i in todo:
                    a, b, k, last = pairs[i]
                    text = "".join([self.plain_text[t] for t in a[-k:]] + [self.plain_text[t] for t in b[:k]])
                    windows.append((text, last and k >= len(b)))
                for i, w in zip(todo, self._runs(windows)):
                    a, b, k, last = pairs[i]
                    if (k >= len(a) or w[0] == a[-k]) and (k >= len(b) or w[-1] == b[k - 1]):
                        done[i] = a[: max(0, len(a) - k)] + w + b[k:]
                    else:
                        pairs[i][2] = 2 * k
            parts = [done[i] for i in range(len(pairs))] + parts[2 * len(pairs) :]
        return np.array(parts[0], self.dtype)

    def decode_bytes(self, ids) -> bytes:
        """UTF-8 of decode(ids, skip_special_tokens=False): without a decoder the library joins tokens with spaces."""
        t = self.token_bytes
        return b" ".join([t[i] for i in ids.tolist()])


@functools.lru_cache(maxsize=2)
def encoder(path: str, long_word: int = LONG_WORD, leaf: int = LEAF) -> WordBpe:
    """One encoder a worker process, kept between tasks."""
    made = WordBpe(path, long_word, leaf)
    give_back()  # the parsed file is several times what is kept
    return made


OUTPUTS = {"n_tokens": "long", "ids": "binary", "decoded": "string", "ids_sha256": "string", "decoded_sha256": "string"}


def encode_decode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", outputs: tuple[str, ...] = ("n_tokens", "ids")) -> DataFrame:
    """Encode every whole text and decode its ids again, one row a document; a null text is empty, a null id stays null.

    outputs: n_tokens, ids (little-endian unsigned 32-bit), decoded, and the SHA-256 of either. Repeated rows give repeated
    rows; an empty table gives an empty one; other columns are left out, whatever their names.
    """
    import pyarrow as pa

    kind = docs.schema[id_col].dataType.simpleString()
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    names = list(outputs)

    def run(batches):
        import numpy as np

        enc = encoder(tokenizer)
        for batch in batches:
            got: dict[str, list] = {n: [] for n in names}
            for text in batch.column("text"):
                ids = enc.encode(text.as_py() or "")
                wide = ids.astype("<u4").tobytes() if {"ids", "ids_sha256"} & set(names) else b""
                decoded = enc.decode_bytes(ids) if {"decoded", "decoded_sha256"} & set(names) else b""
                for n in names:
                    got[n].append(len(ids) if n == "n_tokens" else wide if n == "ids" else hashlib.sha256(wide).hexdigest() if n == "ids_sha256" else decoded.decode() if n == "decoded" else hashlib.sha256(decoded).hexdigest())
            kinds = {"n_tokens": pa.int64(), "ids": pa.binary(), "decoded": pa.string(), "ids_sha256": pa.string(), "decoded_sha256": pa.string()}
            yield pa.RecordBatch.from_arrays([batch.column("id"), *(pa.array(got[n], kinds[n]) for n in names)], names=["id", *names])

    out = src.mapInArrow(lean(run), f"id {kind}, " + ", ".join(f"{n} {OUTPUTS[n]}" for n in names))
    return out.withColumnRenamed("id", id_col)
