"""Exact token counts of prefixes of texts.

White space never enters a token of the given vocabulary, so the count of a prefix is the
count before the word it ends in, plus the count of that (maybe cut) word: a recurrence
over prefixes whose values are stored once and then answer every question. The table of
a text has a row for each word: where the word ends, and the exact count of the prefix
ending there. How many tokens a text has, whether it fits a budget, and how much of it fits,
are look-ups; only the one word that straddles a budget is looked into. It is cut at the tokenizer's own borders (its
pattern, all white space); inside one such piece the prefixes are counted by the same kind of recurrence over
tokens (``PieceCounts``), as far as the budget may reach (a token has a bounded length), not to the end of the word.

Each worker keeps the counts of words it has met, at most ``MEMORY`` words at a time.

Null text: as empty, 0 tokens. Repeated rows, null ids and other columns pass through
unchanged; columns named like a result are replaced by it. A text of any length is read whole; a batch is worked on in slices of a few megabytes.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from thermoflow.llm.batches import slices
from thermoflow.llm.common import map_arrow, read, text_of

VOCABULARY = "word_bpe_49k.json"
BUDGET = 2048
MEMORY = 1_000_000
#: Pieces of more characters are counted by the recurrence over tokens, shorter ones by encoding their prefixes.
LONG = 64
#: White space (the property of that name); none of it makes a token.
_WHITE = re.compile("([\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+)")


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class PieceCounts:
    """Token counts of all prefixes of one piece, by a recurrence over its bytes.

    The merges leave a sequence of tokens alone exactly if they leave each two neighbours alone. So the last token
    of a prefix is the one that ends there and stays beside the last token of what is before it, and the
    count is one more than the count there.
    """

    def __init__(self, tokenizer):
        model = json.loads(tokenizer.to_str())["model"]
        self._normal, self._vocabulary = tokenizer.normalizer.normalize_str, set(model["vocab"])
        self._end = model["end_of_word_suffix"] or ""
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self._rank = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.longest = max(len(t.removesuffix(self._end)) for t in self._vocabulary)
        self._letters, self._beside = _byte_letters(), {}

    def _merged(self, parts: list[str]) -> list[str]:
        while len(parts) > 1:
            least = min(range(len(parts) - 1), key=lambda i: self._rank.get((parts[i], parts[i + 1]), len(self._rank)))
            if (parts[least], parts[least + 1]) not in self._rank:
                break
            parts[least: least + 2] = [parts[least] + parts[least + 1]]
        return parts

    def _stays(self, before: str, letters: str, last: bool) -> bool:
        """Whether these tokens (the first may be empty) are what the merges make of their letters."""
        key = (before, letters, last)
        if (known := self._beside.get(key)) is None:
            parts, token = [*before, *letters], letters
            if last:
                parts[-1] += self._end
                token += self._end
            known = token in self._vocabulary and self._merged(parts) == ([before, token] if before else [token])
            if len(self._beside) >= MEMORY:
                self._beside.clear()
            self._beside[key] = known
        return known

    def _step(self, letters: str, counts: list[int], lasts: list[str], last: bool) -> tuple[int, str]:
        """Tokens of all the letters, and the last token; ``counts`` and ``lasts`` are those of shorter prefixes."""
        n = len(letters)
        for size in range(min(self.longest, n), 0, -1):
            token = letters[n - size:]
            if (token + self._end if last else token) in self._vocabulary and self._stays(lasts[n - size], token, last):
                return counts[n - size] + 1, token
        raise ValueError("a byte without a token")

    def _inside_group(self, piece: str, at: int, to: int, letters: str, counts: list[int], lasts: list[str], budget: int) -> int:
        """The longest fitting prefix that ends inside ``at .. to``, many characters that are normalised together; 0 if none fits.

        Each such prefix is normalised anew, as marks may change places. Their counts rise but for a few tokens at a border, so
        the last fitting one is found by halving, and then among the ``LONG`` behind it.
        """
        def fits(end: int) -> bool:
            added = "".join(self._letters[b] for b in self._normal(piece[at:end]).encode())
            size = self.longest
            now, more, tokens, over = letters[-size:], counts[-size:], lasts[-size:], 0
            for letter in added[:-1]:
                now = (now + letter)[-size:]
                count, token = self._step(now, more[-size:], tokens[-size:], False)
                more.append(count)
                tokens.append(token)
                over = over + 1 if count > budget else 0
                if over > size:
                    return False
            return not added or self._step((now + added[-1])[-size:], more[-size:], tokens[-size:], True)[0] <= budget

        low, high = at, to
        while high - low > 1:
            middle = (low + high) // 2
            low, high = (middle, high) if fits(middle) else (low, middle)
        found = [end for end in range(low + 1, min(low + LONG, to) + 1) if fits(end)]
        return max(found, default=low if low > at else 0)

    def fitting(self, piece: str, budget: int) -> int:
        """The length of the longest prefix of a piece with at most ``budget`` tokens."""
        letters, counts, lasts, best, over, at = "", [0], [""], 0, 0, 0
        while at < len(piece):
            # Characters that are normalised together.
            to = at + 1
            while to < len(piece) and (
                unicodedata.combining(piece[to]) or self._normal(piece[to - 1: to + 1]) != self._normal(piece[to - 1]) + self._normal(piece[to])
            ):
                to += 1
            if to - at > LONG:
                best = max(best, self._inside_group(piece, at, to, letters, counts, lasts, budget))
                ends = [to]
            else:
                ends = range(at + 1, to + 1)
            for end in ends:
                added = "".join(self._letters[b] for b in self._normal(piece[at:end]).encode())
                now, more, tokens = letters, counts[:], lasts[:]
                if end == to:
                    more, tokens = counts, lasts
                for i, letter in enumerate(added):
                    now += letter
                    if i + 1 == len(added) and self._step(now, more, tokens, True)[0] <= budget:
                        best = end
                    count, token = self._step(now, more, tokens, False)
                    more.append(count)
                    tokens.append(token)
                    if end == to:
                        over = over + 1 if count > budget else 0
            letters, at = now, to
            # Every later prefix has one of the last ``longest`` ones before its last token.
            if over > self.longest:
                break
        return best


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class PrefixCounts:
    """Token counts of prefixes, from the counts of words."""

    def __init__(self, path: str, memory: int = MEMORY):
        from tokenizers import Tokenizer

        self._tokenizer, self._memory = Tokenizer.from_file(path), memory
        self._known: dict[str, int] = {"": 0}
        self._pieces = PieceCounts(self._tokenizer)

    def _encoded(self, words: list[str]) -> list[int]:
        return [len(e) for e in self._tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def learn(self, words) -> None:
        """Keep the counts of these words; forget all others first if there are too many."""
        new = [w for w in words if w not in self._known]
        if len(new) + len(self._known) > self._memory:
            self._known, new = {"": 0}, [w for w in words if w]
        self._known.update(zip(new, self._encoded(new)))

    @staticmethod
    def words(text: str) -> list[str]:
        """The parts between blanks and line feeds, the empty ones too, so that positions can be summed."""
        return text.replace("\n", " ").split(" ")

    def table(self, text: str) -> tuple[list[int], list[int]]:
        """For each part: where it ends in the text, and the tokens of the prefix that ends there."""
        words = self.words(text)
        self.learn(set(words))
        ends = [end - 1 for end in accumulate(len(w) + 1 for w in words)]
        return ends, list(accumulate(map(self._known.__getitem__, words)))

    def count(self, text: str, ends: list[int], counts: list[int], length: int) -> int:
        """Tokens of ``text[:length]``."""
        at = int(np.searchsorted(ends, length))
        if ends[at] == length:
            return counts[at]
        before, start = (counts[at - 1], ends[at - 1] + 1) if at else (0, 0)
        return before + self._encoded([text[start:length]])[0]

    def fitting(self, text: str, ends: list[int], counts: list[int], budget: int) -> int:
        """The length of the longest prefix with at most ``budget`` tokens."""
        if counts[-1] <= budget:
            return len(text)
        at = int(np.searchsorted(counts, budget, side="right"))
        before, start = (counts[at - 1], ends[at - 1] + 1) if at else (0, 0)
        for part in _WHITE.split(text[start: ends[at]]):
            count = 0 if _WHITE.fullmatch(part) else self._encoded([part])[0]
            if before + count > budget:
                return start + self._inside(part, budget - before)
            before, start = before + count, start + len(part)
        return start

    def _inside(self, part: str, budget: int) -> int:
        """The same for a text without white space that has more tokens than the budget."""
        # A token has at most ``longest`` bytes, and normalised text half a byte for each character at least.
        head = part[: 2 * self._pieces.longest * (budget + 1) + LONG]
        encoded = self._tokenizer.encode(head, add_special_tokens=False)
        # Where the tokenizer's pieces start, and the tokens before each.
        words, offsets = encoded.word_ids, encoded.offsets
        firsts = [i for i, w in enumerate(words) if not i or w is None or w != words[i - 1]]
        starts = [offsets[i][0] for i in firsts] + [len(head)]
        at = int(np.searchsorted([*firsts, len(encoded)], budget, side="right")) - 1
        if at == len(firsts):
            return len(head)
        # Characters that are normalised together, and added tokens, may move the border before: one piece more on both sides.
        low = max(at - 1, 0)
        if starts[at + 1] - starts[at] > LONG:
            best = starts[at] + self._pieces.fitting(head[starts[at]: starts[at + 1]], budget - firsts[at])
            if best < starts[at + 1]:
                # Marks that change places across the border of pieces may leave a prefix too long by some characters.
                while best > starts[low] and firsts[low] + self._encoded([head[starts[low]:best]])[0] > budget:
                    best -= 1
                return best
        after = starts[min(at + 2, len(firsts))]
        lengths = range(min(after, starts[at + 1] + LONG), starts[at], -1)
        for some in (lengths[i: i + LONG] for i in range(0, len(lengths), LONG)):
            for length, n in zip(some, self._encoded([head[starts[low]:x] for x in some])):
                if firsts[low] + n <= budget:
                    return length
        return starts[at]


@cache
def _counter(path: str) -> PrefixCounts:
    return PrefixCounts(path)


def prefix_tables(df: DataFrame, path: str | None = None, text: str = "text", tables: bool = False,
                  budget: int = BUDGET) -> DataFrame:
    """The input without its text and with ``n_bytes, n_tokens, fitting_chars``.

    ``fitting_chars`` is the length of the longest prefix within the budget. With
    ``tables`` also ``prefix_ends`` and ``prefix_tokens``, the table of each text.
    """
    path = path or vocabulary_path()
    added = [T.StructField("n_tokens", T.LongType()), T.StructField("fitting_chars", T.LongType())]
    if tables:
        added += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("prefix_ends", "prefix_tokens")]
    kept = [c for c in df.columns if c not in {text, "n_bytes", *(f.name for f in added)}]
    body = df.select(*kept, text_of(text).alias(text)).withColumn("n_bytes", F.octet_length(text).cast("bigint"))
    schema = T.StructType([f for f in body.schema if f.name != text] + added)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for batch in slices(batches, text):
            texts = batch.column(text).to_pylist()
            counter.learn({w for t in texts for w in counter.words(t)})
            out = {f.name: [] for f in added}
            for t in texts:
                ends, counts = counter.table(t)
                out["n_tokens"].append(counts[-1])
                out["fitting_chars"].append(counter.fitting(t, ends, counts, budget))
                if tables:
                    out["prefix_ends"].append(ends)
                    out["prefix_tokens"].append(counts)
            rest = batch.drop_columns([text])
            arrays = [pa.array(v, pa.list_(pa.int32()) if n.startswith("prefix") else pa.int64()) for n, v in out.items()]
            yield pa.RecordBatch.from_arrays([*rest.columns, *arrays], names=[*rest.schema.names, *out])

    return map_arrow(body, count, schema)


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    documents = read(spark, folder, "documents").select("doc_id", "text")
    return prefix_tables(documents).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > BUDGET).alias("over_limit"), "fitting_chars"
    )
