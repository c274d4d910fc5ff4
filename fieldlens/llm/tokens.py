"""Token counts: batch encoding inside Arrow functions, only lengths come back.

Long texts are cut at safe boundaries. White space opens a token and never ends one in the tokenizers used here, so a
text may be cut wherever a character that is no white space meets white space, and the counts of the pieces add up to
that of the whole text. The tokenizers of ``tokenizers`` also part letters from digits, so long runs without white space
are cut there. Equal pieces are encoded once per Python worker; what is still unknown goes to the library in
batches of about equal bytes.
"""

import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.llm.common import keep

# Characters with the Unicode property White_Space, fixed values.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
# Where a letter meets a digit, for pieces above so many characters.
TURN, LONG_PIECE = re.compile("(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])"), 4_096
# For sentencepiece: a single blank between two ASCII letters or digits, which the next piece's own mark stands for.
BLANK = re.compile("(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")

BATCH_BYTES = 1 << 18
KNOWN_PIECES = 400_000
# Pieces above this length are encoded but not remembered.
KNOWN_CHARS = 64

_LOADED = {}


def cut_pieces(text):
    """Pieces of a text whose tokens add up to those of the text."""
    pieces = PIECE.findall(text)
    if len(text) <= LONG_PIECE or max(map(len, pieces), default=0) <= LONG_PIECE:
        return pieces
    return [part for piece in pieces for part in (TURN.split(piece) if len(piece) > LONG_PIECE else (piece,))]


class _Counter:
    """Counts tokens of whole texts with one tokenizer, remembering short pieces."""

    def __init__(self, tokenizer):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        path = tokenizer
        if not os.path.isfile(path):
            import public_tokenizers

            path = public_tokenizers.path(tokenizer)
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.lengths = lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
            self.cut = BLANK.split
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self.lengths = lambda texts: [len(e) for e in model.encode_batch_fast(texts, add_special_tokens=False)]
            self.cut = cut_pieces
        self.known = {}

    def learn(self, pieces):
        """Encode pieces in batches of about equal bytes, similar lengths together."""
        found, batch, size = {}, [], 0
        for piece in sorted(pieces, key=len):
            batch.append(piece)
            size += len(piece.encode())
            if size >= BATCH_BYTES:
                found.update(zip(batch, self.lengths(batch), strict=True))
                batch, size = [], 0
        if batch:
            found.update(zip(batch, self.lengths(batch), strict=True))
        return found

    def counts(self, texts):
        """Tokens of each text; all of a batch's new pieces are encoded together."""
        if len(self.known) > KNOWN_PIECES:
            self.known.clear()
        known, out, later, new, held = self.known, [0] * len(texts), [], set(), 0

        def settle():
            nonlocal held
            found = self.learn(new)
            for i, pieces in later:
                out[i] += sum(map(found.__getitem__, pieces))
            known.update((p, n) for p, n in found.items() if len(p) <= KNOWN_CHARS)
            later.clear()
            new.clear()
            held = 0

        for i, text in enumerate(texts):
            if not text:
                continue
            lengths = list(map(known.get, pieces := self.cut(text)))
            if None in lengths:
                missing = [p for p, n in zip(pieces, lengths, strict=True) if n is None]
                out[i] = sum(n for n in lengths if n is not None)
                later.append((i, missing))
                new.update(missing)
                held += sum(map(len, missing))
                if held > 8 * BATCH_BYTES:
                    settle()
            else:
                out[i] = sum(lengths)
        settle()
        return out


def _counter(tokenizer):
    if tokenizer not in _LOADED:
        _LOADED[tokenizer] = _Counter(tokenizer)
    return _LOADED[tokenizer]


def token_counts(docs, tokenizer="byte_bpe_50k.json", text="text", carry=("doc_id",), limit=512):
    """One row per row of ``docs``: the columns in ``carry``, n_bytes, n_tokens, over_limit (n_tokens > limit).

    ``tokenizer`` is a file or a name known to ``public_tokenizers``; ``.json`` goes to tokenizers, ``.model`` to
    sentencepiece. No begin, end or other added tokens; strings of special tokens inside a text are read as the library
    does by default; nothing is truncated or padded. A null or empty text has 0 bytes and 0 tokens. A carried column with the
    name of a result makes way for it, other columns are not read; repeated rows are counted each; an empty table gives an empty result.
    """
    carry = [c for c in dict.fromkeys(carry) if c.lower() not in {"n_bytes", "n_tokens", "over_limit", text.lower()}]
    found = keep(docs, *carry, text).withColumn(text, F.col(text).cast("string"))
    schema = T.StructType([*[found.schema[c] for c in carry], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType())])

    def count(batches):
        counter = _counter(tokenizer)
        for batch in batches:
            texts = batch.column(text).to_pylist()
            sizes = np.array([len(t.encode()) if t else 0 for t in texts], dtype="int64")
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carry], pa.array(sizes), pa.array(counter.counts(texts), pa.int64())],
                names=[*carry, "n_bytes", "n_tokens"])

    return found.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
