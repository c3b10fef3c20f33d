"""Token counts under a unigram vocabulary, by dynamic programming shared in a trie.

A text's pre-tokens are its runs of characters other than ASCII white space, each with
the word mark in front, as the vocabulary writes them. A pre-token's count is the number
of pieces on its best path: largest sum of piece scores, then fewest pieces. A character
that is no piece of its own falls back to its UTF-8 bytes, one token each.

Each task keeps a trie of the distinct pre-tokens it has met. A node stands for a prefix
and holds that prefix's forward score and count, computed once from the nodes above it
over all pieces that end there; a pre-token that shares a prefix starts below it, and
its count stays at its terminal. A full trie (``max_nodes``) is begun anew with the next
pre-token; the rest of a pre-token that fills it is computed with no more than the
scores of the last prefixes that a piece can reach back to. Neither changes a result, and
they bound a task's memory, whatever a text without blanks holds. The work is one map
over whole texts.

Piece scores come from the vocabulary file alone, which is read and never trained: a
unigram model's own; for a merge vocabulary, whose entries stand in order of frequency,
the log-probability of Zipf's law at that rank. The file is a parameter, read by the
driver; its pieces (one per entry of the file, its size bounds them) are broadcast.

Null and empty texts have no pre-tokens. Repeated rows count alike; other columns are
ignored.
"""

from __future__ import annotations

import math
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadence.llm.common import map_texts, prepare

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MAX_NODES = 1_000_000
#: What a fallback byte scores below the vocabulary's rarest piece.
BYTE_PENALTY = 10.0


def load_scores(path: str = VOCABULARY) -> dict[str, float]:
    """Piece -> score of the ordinary pieces of a vocabulary file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = [i for i in range(model.get_piece_size())
           if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    scores = {model.id_to_piece(i): float(model.get_score(i)) for i in ids}
    if all(s == round(s) and s <= 0 for s in scores.values()):  # ranks of merges, no probabilities
        norm = math.log(sum(1.0 / (r + 1) for r in range(len(ids))))
        scores = {model.id_to_piece(i): -math.log(r + 1) - norm for r, i in enumerate(ids)}
    return scores


class TrieCounts(dict):
    """Pre-token (UTF-8 bytes) -> its number of tokens."""

    #: Bytes beyond which a pre-token's path is not held whole.
    LONG = 4096

    def __init__(self, scores: dict[str, float], mark: str = MARK, max_nodes: int = MAX_NODES):
        super().__init__()
        self.mark, self.max_nodes = mark, max_nodes
        self.byte = min(scores.values(), default=0.0) - BYTE_PENALTY
        # every ending of a piece -> the piece's score, or None if it is an ending only:
        # the pieces that end at a character are found by going back until none ends so
        self.endings: dict[str, float | None] = {}
        for piece in scores:
            for i in range(len(piece)):
                self.endings[piece[i:]] = None
        self.endings.update(scores)
        self.longest = max(map(len, scores), default=1)
        self.start()

    def start(self) -> None:
        self.clear()
        self.child: dict[int, int] = {}
        self.score, self.count = array("d", [0.0]), array("i", [0])

    def __missing__(self, token: bytes) -> int:
        if 2 * len(token) > self.max_nodes or len(token) > self.LONG:
            return self._long(token)
        if len(self.score) + len(token) >= self.max_nodes:
            self.start()
        word = self.mark + token.decode("utf-8", "replace")
        node, path = 0, [0]
        child, score, count, endings = self.child, self.score, self.count, self.endings.get
        for end, ch in enumerate(word, 1):
            key = node << 21 | ord(ch)
            above, node = node, child.get(key)
            if node is None:
                best, pieces = -math.inf, 0
                begin = end - 1
                while begin >= 0:
                    s = endings(word[begin:end], self)
                    if s is self:
                        break
                    if s is not None:
                        at = path[begin]
                        total, k = score[at] + s, count[at] + 1
                        if total > best or total == best and k < pieces:
                            best, pieces = total, k
                    begin -= 1
                if endings(ch) is None:  # no piece of its own: its bytes
                    n = len(ch.encode("utf-8", "replace"))
                    total, k = score[above] + n * self.byte, count[above] + n
                    if total > best or total == best and k < pieces:
                        best, pieces = total, k
                node = child[key] = len(score)
                score.append(best)
                count.append(pieces)
            path.append(node)
        self[token] = count[node]
        return count[node]

    def _long(self, token: bytes) -> int:
        """The count of a long pre-token, with the last prefixes' scores alone beside the
        trie, which it enters as far as there is room."""
        word = self.mark + token.decode("utf-8", "replace")
        # best score and count of the last prefixes, those of length ``base`` and on
        best_of, count_of, base, node = [0.0], [0], 0, 0
        child, score, count, endings = self.child, self.score, self.count, self.endings.get
        for end, ch in enumerate(word, 1):
            key = node << 21 | ord(ch)
            below = child.get(key) if node >= 0 else None
            if below is not None:
                best, pieces = score[below], count[below]
            else:
                best, pieces = -math.inf, 0
                begin = end - 1
                while begin >= 0:
                    s = endings(word[begin:end], self)
                    if s is self:
                        break
                    if s is not None:
                        total, k = best_of[begin - base] + s, count_of[begin - base] + 1
                        if total > best or total == best and k < pieces:
                            best, pieces = total, k
                    begin -= 1
                if endings(ch) is None:  # no piece of its own: its bytes
                    n = len(ch.encode("utf-8", "replace"))
                    total, k = best_of[-1] + n * self.byte, count_of[-1] + n
                    if total > best or total == best and k < pieces:
                        best, pieces = total, k
                if node >= 0 and len(score) <= self.max_nodes:
                    below = child[key] = len(score)
                    score.append(best)
                    count.append(pieces)
                else:
                    below = -1
            node = below
            best_of.append(best)
            count_of.append(pieces)
            if len(best_of) > 4096 + self.longest:
                drop = len(best_of) - self.longest
                del best_of[:drop], count_of[:drop]
                base += drop
        if node >= 0:
            self[token] = count_of[-1]
        return count_of[-1]


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY,
                 max_nodes: int = MAX_NODES) -> DataFrame:
    """id, n_words (pre-tokens) and n_tokens of every row."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load_scores(vocabulary))

    def factory():
        counts = TrieCounts(shared.value, max_nodes=max_nodes)

        def run(data: np.ndarray, off: np.ndarray):
            raw = data.tobytes()
            words, tokens = [], []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist()):
                own = raw[a:b].split()  # bytes: ASCII white space only
                words.append(len(own))
                tokens.append(sum(map(counts.__getitem__, own)))
            return words, tokens

        return run

    return map_texts(docs, text_col, factory, [("n_words", pa.int64(), "bigint"), ("n_tokens", pa.int64(), "bigint")], [id_col])
