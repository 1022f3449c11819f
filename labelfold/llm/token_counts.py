"""Operator 3: token counts with overlap resynchronisation.

A text of more than ``chunk`` characters is encoded in overlapping chunks with
offsets and spliced: inside the overlap of two chunks a cut is taken at a
*common stable boundary*, a place where both encodings begin a token and where
a character that is not white space is followed by white space.  Such a place
is a boundary of the whole text's encoding whatever stands left or right of the
chunk: the byte-level pattern lets white space only begin a piece, its pieces
look ahead no further than the next character, merges never cross pieces, and
no special string holds white space.  When an overlap has no such place (a long
run without white space) it is widened, twofold each time, up to the rest of
the text.

The same boundaries make a shorter text's count the sum over its words, each
with the space before it, so a task encodes every different word once (its
table of counts is bounded and refilled); a text in which a space follows other
white space is encoded whole.  A task holds one batch of texts and the tokens
of one widened chunk; there is no shuffle.

Defined results: a null text is empty: 0 bytes and 0 tokens; special strings in a
text count as the library counts them (one token each); repeated rows are
counted each; an empty table gives an empty table; other columns are never read.

Both ways hold for byte-level vocabularies with the pattern of ``PATTERN`` and no normaliser.  The
vocabulary's file is asked for that (``has_stable_boundaries``); with any other one, and with a
sentencepiece ``.model``, every text is encoded whole by its library.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelfold.llm.common import text_of

VOCABULARY = "byte_bpe_50k.json"
#: White space here is a superset of the library's, so what doesn't match is surely a stable boundary.
SPACE_AFTER_SPACE = re.compile(r"\s ")


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


@lru_cache(maxsize=4)
def _sentences(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(maxsize=4)
def has_stable_boundaries(path: str) -> bool:
    """Whether the splice and the word sums give what the library gives, by the vocabulary's own file."""
    if path.endswith(".model"):
        return False
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    pre, model = d.get("pre_tokenizer") or {}, d["model"]
    added = d.get("added_tokens") or []
    return (not d.get("normalizer") and pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space")
            and pre.get("use_regex", True) and model.get("type", "BPE") == "BPE" and not model.get("dropout")
            and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
            and not any(re.search(r"\s", a["content"]) or a.get("lstrip") or a.get("rstrip") or a.get("single_word")
                        for a in added))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _encode(t, text: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids, first character of each token)."""
    e = t.encode(text, add_special_tokens=False)
    at = np.fromiter((a for a, _ in e.offsets), dtype=np.int64, count=len(e.ids))
    return np.asarray(e.ids, dtype=np.int64), at


def _cut(text: str, left, right, begin: int, end: int) -> int | None:
    """The last common stable boundary in text[begin:end], or None.

    left and right are sorted token starts; offsets may leave out the space a
    token begins with, so the token that holds the white space must start there
    in both encodings: that is checked on the starts at or right after it."""
    for p in range(end - 2, begin, -1):
        if text[p].isspace() and not text[p - 1].isspace():
            a, b = np.searchsorted(left, p), np.searchsorted(right, p)
            if a < len(left) and b < len(right) and left[a] == right[b] and left[a] <= p + 1:
                return p
    return None


def encode_spliced(t, text: str, chunk: int = 1 << 16, overlap: int = 1 << 9) -> np.ndarray:
    """The ids of the whole text from overlapping chunks."""
    n, out, begin, end = len(text), [], 0, min(len(text), chunk)
    ids, at = _encode(t, text[begin:end])
    at = at + begin
    while end < n:
        width = overlap
        while True:
            # the next chunk reaches back over the overlap; a failed alignment widens both ways
            nb, ne = max(begin, end - width), min(n, end - width + chunk + width)
            nids, nat = _encode(t, text[nb:ne])
            nat = nat + nb
            cut = _cut(text, at, nat, nb, end)
            if cut is not None:
                break
            if nb == begin:  # no stable place in the whole chunk: encode it together with what follows
                end = min(n, end + max(chunk, end - begin))
                ids, at = _encode(t, text[begin:end])
                at = at + begin
                if end >= n:
                    break
                width = overlap
            else:
                width *= 2
        if end >= n and cut is None:
            break
        k, m = np.searchsorted(at, cut), np.searchsorted(nat, cut)
        out.append(ids[:k])
        ids, at, begin, end = nids[m:], nat[m:], cut, ne
    out.append(ids)
    return np.concatenate(out)


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable
    bytes stand for themselves, the others for the letters from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return {b: chr(b if b in own else next(rest)) for b in range(256)}


class WordCounts:
    """Tokens of texts as sums over words, each with the space before it."""

    #: Words kept, and the longest that is kept: bounds of the table's memory.
    KEEP, LONGEST = 1 << 19, 40

    def __init__(self, t):
        import public_tokenizers

        self.t, self.model, self.seen = t, t.model, {}
        self.letters, self.pieces = _byte_letters(), regex.compile(public_tokenizers.PATTERN).findall
        self.special = [a.content for a in t.get_added_tokens_decoder().values()]

    def encode(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.t.encode_batch_fast(texts, add_special_tokens=False)]

    def word(self, w: str) -> int:
        """Tokens of one word with the space before it, by the library's merges of its pieces."""
        if len(w) > self.LONGEST or any(x in w for x in self.special):
            return self.encode([" " + w])[0]
        w = " " + w
        return sum(len(self.model.tokenize(p.encode().decode("latin-1").translate(self.letters)))
                   for p in ([w] if w[1:].isalpha() else self.pieces(w)))

    def count(self, texts: list[str]) -> list[int]:
        plain = [not SPACE_AFTER_SPACE.search(x) for x in texts]
        # the first word has no space before it: it is looked up as a text of its own
        parts = [(" " + x).split(" ")[1:] if ok else [] for x, ok in zip(texts, plain)]
        words = set().union(*(p[1:] for p in parts))
        own, seen = {}, self.seen
        for w in words:
            if (n := seen.get(w)) is not None:
                own[w] = n
        new = [w for w in words if w not in own]
        if len(seen) + len(new) > self.KEEP:
            seen.clear()
        for w in new:
            n = own[w] = self.word(w)
            if len(w) <= self.LONGEST and len(seen) < self.KEEP:
                seen[w] = n
        alone = [p[0] if ok else x for x, p, ok in zip(texts, parts, plain)]
        out = []
        for k in range(0, len(alone), 64):
            out += self.encode(alone[k:k + 64])
        return [n + sum(map(own.__getitem__, p[1:])) for n, p in zip(out, parts)]


def _whole(path: str, texts: list[str]) -> list[int]:
    """Token counts by the library alone, a few texts at a time."""
    out = []
    for k in range(0, len(texts), 64):
        part = texts[k:k + 64]
        if path.endswith(".model"):
            out += map(len, _sentences(path).encode(part, num_threads=1))
        else:
            out += [len(e) for e in _tokenizer(path).encode_batch(part, add_special_tokens=False)]
    return out


def _count(path: str, id_col: str, chunk: int, overlap: int):
    def run(batches):
        if not has_stable_boundaries(path):
            for df in batches:
                counts = np.array(_whole(path, df["text"].tolist()), dtype=np.int64)
                yield pd.DataFrame({id_col: df[id_col], "n_bytes": df["n_bytes"], "n_tokens": counts})
            return
        words = WordCounts(_tokenizer(path))
        for df in batches:
            texts, counts = df["text"].tolist(), np.zeros(len(df), dtype=np.int64)
            short = [i for i, x in enumerate(texts) if len(x) <= chunk]
            for k in range(0, len(short), 256):
                part = short[k:k + 256]
                counts[part] = words.count([texts[i] for i in part])
            for i, x in enumerate(texts):
                if len(x) > chunk:
                    counts[i] = len(encode_spliced(words.t, x, chunk, overlap))
            yield pd.DataFrame({id_col: df[id_col], "n_bytes": df["n_bytes"], "n_tokens": counts})
    return run


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
                 limit: int = 512, chunk: int = 1 << 16, overlap: int = 1 << 9) -> DataFrame:
    """One row per document: id, n_bytes, n_tokens, over_limit."""
    rows = docs.select(F.col(id_col), text_of(text_col).alias("text"))
    rows = rows.withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = rows.schema[id_col].dataType.simpleString()
    return (rows.mapInPandas(_count(vocabulary or vocabulary_path(), id_col, chunk, overlap),
                             f"{id_col} {kind}, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
