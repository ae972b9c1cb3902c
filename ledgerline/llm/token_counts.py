"""Token counts under a unigram model of pieces: dynamic programming over a trie of pre-tokens.

A pre-token is a white-space separated word with the word mark before it. The distinct pre-tokens of a batch go into a
trie; a node stands for a prefix, and its forward score, the best sum of piece scores over all ways to cut the prefix into
pieces, is computed once for all words that share it. Nodes that end a word keep the number of pieces of the
best cut. Counts of texts are sums over their words. Words met before by the same Python worker aren't computed again;
what it remembers is bounded in bytes, and a trie in letters. A word of over LONG_WORD letters has no prefix to share: it is
cut by itself, holding no more scores than the longest piece has letters.

Pieces come from a public vocabulary file, ordered by how common they are: the score of the piece of rank r is
-log(r + 2.7), up to a constant that all pieces share (Mandelbrot's law). Characters that no piece covers cost their
UTF-8 bytes, a token each, at a score below every piece's. Of equal scores the cut with fewer pieces wins.

Rows: null and empty texts have no tokens; repeated rows repeat; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.common import coded_words, row_sums, slices, table

MARK = "▁"
#: Bytes of words that a Python worker remembers, letters of a trie, and the longest word that goes into one.
REMEMBERED, LETTERS, LONG_WORD = 160 << 20, 1 << 20, 256


def load_pieces(path: str) -> dict[str, float]:
    """The pieces of a sentencepiece file with their scores; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    return {p: -math.log(r + 2.7) for r, p in enumerate(plain)}


class Trie:
    """Children by letter, forward score and number of pieces of each node; node 0 is the empty prefix."""

    def __init__(self, pieces: dict[str, float]) -> None:
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=1)
        # Only a piece's end decides where to look: the lengths of pieces by their last letter.
        lengths: dict[str, set[int]] = {}
        for p in pieces:
            lengths.setdefault(p[-1], set()).add(len(p))
        self.lengths = {c: sorted(n) for c, n in lengths.items()}
        self.unknown = min(pieces.values(), default=0.0) - 10.0
        self.children: list[dict[str, int]] = [{}]
        self.score, self.count = [0.0], [0]

    def add(self, word: str) -> int:
        """The number of tokens of `word`, whose new prefixes become nodes."""
        node, path = 0, [0]
        for end, letter in enumerate(word, 1):
            nxt = self.children[node].get(letter)
            if nxt is None:
                bytes_ = len(letter.encode("utf-8", "surrogatepass"))
                best, fewest = self.score[node] + bytes_ * self.unknown, self.count[node] + bytes_
                for n in self.lengths.get(letter, ()):
                    if n > end:
                        break
                    own = self.pieces.get(word[end - n : end])
                    if own is not None:
                        start = path[end - n]
                        s, c = self.score[start] + own, self.count[start] + 1
                        if s > best or s == best and c < fewest:
                            best, fewest = s, c
                nxt = len(self.score)
                self.children[node][letter] = nxt
                self.children.append({})
                self.score.append(best)
                self.count.append(fewest)
            node = nxt
            path.append(node)
        return self.count[node]


    def cut(self, word: str) -> int:
        """The number of tokens of `word`, without a node."""
        score, count, size = [0.0] * (self.longest + 1), [0] * (self.longest + 1), self.longest + 1
        for end, letter in enumerate(word, 1):
            bytes_, last = len(letter.encode("utf-8", "surrogatepass")), (end - 1) % size
            best, fewest = score[last] + bytes_ * self.unknown, count[last] + bytes_
            for n in self.lengths.get(letter, ()):
                if n > end:
                    break
                own = self.pieces.get(word[end - n : end])
                if own is not None:
                    s, c = score[(end - n) % size] + own, count[(end - n) % size] + 1
                    if s > best or s == best and c < fewest:
                        best, fewest = s, c
            score[end % size], count[end % size] = best, fewest
        return count[len(word) % size]


_PIECES: dict[str, dict[str, float]] = {}
_KNOWN: dict[str, dict[str, int]] = {}
_HELD: dict[str, int] = {}


def word_counts(words: list[str], path: str) -> np.ndarray:
    """The number of tokens of each of the distinct `words`."""
    if path not in _PIECES:
        _PIECES[path], _KNOWN[path], _HELD[path] = load_pieces(path), {}, 0
    known = _KNOWN[path]
    if _HELD[path] > REMEMBERED:
        known.clear()
        _HELD[path] = 0
    new = sorted(w for w in words if w not in known)  # neighbours share prefixes: one trie for a run of them is small
    trie, room = None, 0
    for w in new:
        if len(w) > LONG_WORD:
            known[w] = (trie or Trie(_PIECES[path])).cut(MARK + w)
            continue
        if room <= 0:
            trie, room = Trie(_PIECES[path]), LETTERS
        known[w] = trie.add(MARK + w)
        room -= len(w)
        _HELD[path] += 220 + len(w)
    counts = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
    for w in new:
        if len(w) > LONG_WORD:
            del known[w]
    return counts


def token_counts(df: DataFrame, pieces: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_words, n_tokens) of every whole text; `pieces` is the path of a sentencepiece vocabulary on every machine."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words, codes, counts = coded_words(batch.column(1))
            tokens = row_sums(word_counts(words, pieces)[codes], counts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts.astype(np.int64)), pa.array(tokens.astype(np.int64))], [id_col, "n_words", "n_tokens"])

    out = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_tokens", T.LongType())])
    return df.select(id_col, F.col(text_col)).mapInArrow(run, out)


def op1_token_counts(spark, sf_dir):
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
