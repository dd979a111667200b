"""Token counts with a shortcut for words that are one token."""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices
from .tokenizer import load

#: The split before the merges of a byte-level vocabulary (fixed by that format).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Pre-tokens whose counts a task remembers besides the proven ones before it starts over.
REMEMBERED = 200_000

#: Characters that both splits class alike: up to Latin Extended-B without the separators
#: 1C-1F, general punctuation without its spaces. A text with another is given to the library.
_SURE = regex.compile(r"[\x00-\x1B\x20-\x84\x86-ɏ‐-‧‰-⁞]*")


class Counter:
    """Counts tokens of whole texts as the library does."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        before = file["pre_tokenizer"] or {}
        plain = before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space")
        added = file["added_tokens"]
        plain = plain and not file["normalizer"] and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in added)
        self.split = regex.compile(PATTERN) if plain and file["model"]["type"] == "BPE" else None
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in sorted(added, key=lambda t: -len(t["content"])))) if added else None
        self.whole = self._prove() if self.split else {}
        self.seen = dict(self.whole)

    def _prove(self) -> dict[str, int]:
        """Strings of the vocabulary that are one pre-token and encode alone as one token."""
        vocab = self.tokenizer.get_vocab_size(with_added_tokens=False)
        texts = [self.tokenizer.decode([i]) for i in range(vocab)]
        texts = [t for t in texts if "�" not in t and _SURE.fullmatch(t) and self.split.fullmatch(t)]
        encoded = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return {t: 1 for t, e in zip(texts, encoded, strict=True) if len(e.ids) == 1}

    def _merge(self, new: list[str]) -> None:
        for i in range(0, len(new), 10_000):
            part = new[i : i + 10_000]
            for token, got in zip(part, self.tokenizer.encode_batch(part, add_special_tokens=False), strict=True):
                self.seen[token] = len(got.ids)

    def count(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; null has none."""
        if len(self.seen) > len(self.whole) + REMEMBERED:
            self.seen = dict(self.whole)
        out, split = [], []
        for text in texts:
            n, tokens = 0, []
            if text and (self.split is None or not _SURE.fullmatch(text)):
                n = len(self.tokenizer.encode(text, add_special_tokens=False).ids)
            elif text:
                parts = self.special.split(text) if self.special else [text]
                n = len(parts) - 1
                for part in parts:
                    tokens += self.split.findall(part)
            out.append(n)
            split.append(tokens)
        self._merge(list({t for tokens in split for t in set(tokens)} - self.seen.keys()))
        find = self.seen.__getitem__
        return [n + sum(map(find, tokens)) for n, tokens in zip(out, split, strict=True)]


@functools.lru_cache(maxsize=2)
def counter(path: str) -> Counter:
    return Counter(path)


def token_counts(docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` for every row, as the library counts whole texts.

    Null and empty texts have no bytes and no tokens. Strings of special tokens inside a text
    count as the library's default takes them, as one token. Rows stay in their task; keys
    are handed through, null or repeated.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 20):
                counts = counter(tokenizer).count(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("n_bytes"), pa.array(counts, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).cast("string").alias("text"))
    counted = rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
