"""Token counts under a unigram model, with forward scores shared in a trie.

A text's pre-tokens (blank-parted, with the word mark before them) are segmented into pieces of the
vocabulary so that the sum of the pieces' log probabilities is greatest; among equals the one of fewer
pieces. Distinct pre-tokens go into a trie whose nodes keep the best score and count of the prefix
they stand for, so what pre-tokens share at their beginning is computed once; the node where one ends
has its token count. A text's count is the sum over its pre-tokens. Documents are not shuffled;
terminals are forgotten beyond ``most_terminals`` and counted anew when met again.

The vocabulary file ranks pieces but has no probabilities; a piece of rank r has -log(r + 2.7) (Zipf).
A character outside the vocabulary costs a piece for each of its bytes.

Cases: null and empty texts have no tokens. Texts and pre-tokens of any length are counted whole.
Repeated rows are counted each; extra columns stay, n_pretokens and n_tokens are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waybill.llm.arrays import column_of, gathered

MARK = "▁"
BYTE_SCORE = -25.0
_WIDE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def scores_of(path: str) -> dict[str, float]:
    """Log probability of every piece of a vocabulary file; control and byte pieces are left out."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return {
        model.id_to_piece(i): -math.log(i + 2.7) for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    }


class ForwardTrie:
    """The trie of pre-tokens, grown in sorted order so that only the branch to the last one is held.

    Sorted pre-tokens visit a trie depth first: each begins at the node where it leaves the one before,
    whose prefix scores are still on the branch. What stays is the token count of every terminal.
    """

    def __init__(self, scores: dict[str, float], terminal: dict[str, int] | None = None) -> None:
        self.scores = scores
        self.longest = max((len(x) for x in scores if MARK not in x[1:]), default=1)
        self.terminal: dict[str, int] = {} if terminal is None else terminal

    def insert(self, words: set[str]) -> None:
        """Computes the token counts of pre-tokens."""
        scores, longest, terminal = self.scores, self.longest, self.terminal
        score, count, last = [0.0], [0], ""
        for plain in sorted(words):
            word = MARK + plain
            shared, most = 0, min(len(last), len(word))
            while shared < most and word[shared] == last[shared]:
                shared += 1
            del score[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                size = len(word[end - 1].encode())
                best, fewest = score[end - 1] + size * BYTE_SCORE, count[end - 1] + size
                for start in range(end - longest if end > longest else 0, end):
                    own = scores.get(word[start:end])
                    if own is not None:
                        own += score[start]
                        if own > best or own == best and count[start] + 1 < fewest:
                            best, fewest = own, count[start] + 1
                score.append(best)
                count.append(fewest)
            terminal[plain] = count[-1]
            last = word


def _split(text: str | None) -> list[str]:
    """Words parted by the six ASCII blanks and nothing else."""
    if not text:
        return []
    if _WIDE.search(text):  # what str.split would also part
        return [x.decode() for x in text.encode().split()]
    return text.split()


def count_tokens(documents: DataFrame, vocabulary: str, text: str = "text", most_terminals: int = 800_000) -> DataFrame:
    """Adds n_pretokens and n_tokens; one pass, no shuffle."""
    kept = [x for x in documents.columns if x.lower() not in ("n_pretokens", "n_tokens")]
    own = T.StructType([*(documents.schema[x] for x in kept), T.StructField("n_pretokens", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        # The terminals' counts last as long as the Python worker.
        kept_counts = sentencepiece.__dict__.setdefault("kept_counts", {})
        trie = ForwardTrie(scores_of(vocabulary), kept_counts.setdefault(vocabulary, {}))
        for rows in gathered(batches, text, 1 << 23):
            parts = [_split(x) for x in column_of(rows, text).to_pylist()]
            if len(trie.terminal) > most_terminals:
                trie.terminal.clear()
            trie.insert(set().union(*parts) - trie.terminal.keys())
            known = trie.terminal.__getitem__
            words, tokens = [len(x) for x in parts], [sum(map(known, x)) for x in parts]
            yield from pa.table([*(rows.column(x) for x in kept), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=own.names).to_batches()

    return documents.select(*(F.col(f"`{x}`") for x in kept)).mapInArrow(counted, own)
