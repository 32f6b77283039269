"""Toxicity scores by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: letters in lower case, look-alike letters and digit substitutions brought to
plain letters, punctuation and white space to single blanks between words. Lexicon terms are words
or beginnings of words; their weights are log odds learned from labelled documents. Exception
phrases, a term with a neighbouring word or a longer word around a term, cancel the hits inside
them. The summed weights, with and without normalisation by length, give the score by a logistic
curve.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import fit_logistic, held_out, map_batches, map_texts, squash, text_function, training_labels, with_text

#: Letters that look alike, and digits and marks written for letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a",
    "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɡ": "g", "ո": "n", "ս": "u",
}
SUBSTITUTIONS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a",
                 "$": "s"}
_INVISIBLE = "­​‌‍⁠﻿"
_FOLD = str.maketrans(
    {**HOMOGLYPHS, **SUBSTITUTIONS, **dict.fromkeys(_INVISIBLE, "")}
    | {chr(0xFF41 + i): chr(97 + i) for i in range(26)}
)
_GAP = re.compile(r"[\W_]+")
_LEAST, _MOST = 4, 10


def fold(text: str) -> str:
    """Folded words with a blank before, between and after them.

    A run of ``$`` or ``@`` at the end of a word is taken as punctuation, not as letters.
    """
    low = text.lower()
    if "$" in low or "@" in low:
        low = re.sub(r"[$@]+(?!\w)", " ", low)
    return f" {_GAP.sub(' ', low.translate(_FOLD)).strip()} "


def candidates(folded: str) -> set[str]:
    """What may become a term: whole words, and their beginnings of 4 to 10 letters."""
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        for k in range(_LEAST, min(_MOST, len(word) - 1) + 1):
            found.add(" " + word[:k])
    return found


@dataclass
class Lexicon:
    """Terms with weights, exception phrases, and the curve from measures to scores."""

    terms: dict[str, float]
    exceptions: set[str] = field(default_factory=set)
    curve: np.ndarray = field(default_factory=lambda: np.zeros(5))

    def matcher(self):
        """A function from a folded text to its hits (start, end, term) outside exceptions."""
        import ahocorasick

        if not self.terms:
            return lambda folded: []
        machine = ahocorasick.Automaton()
        for phrase in self.terms.keys() | self.exceptions:
            machine.add_word(phrase, phrase)
        machine.make_automaton()
        terms, exceptions = self.terms, self.exceptions

        def hits(folded: str) -> list[tuple[int, int, str]]:
            found = [(end + 1 - len(p), end + 1, p) for end, p in machine.iter(folded)]
            if not found:
                return found
            freed = [(a, b) for a, b, p in found if p in exceptions]
            return [
                (a, b, p)
                for a, b, p in found
                if p in terms and not any(x <= a and b <= y for x, y in freed)
            ]

        return hits

    def measures(self, folded: str, hits: list[tuple[int, int, str]]) -> list[float]:
        """Sum of weights, the sum over the root and the log of the word count, the largest."""
        best: dict[int, float] = {}
        for a, _, p in hits:  # of several terms that begin at a word, the heaviest counts
            best[a] = max(best.get(a, 0.0), self.terms[p])
        total, words = sum(best.values()), folded.count(" ")
        return [
            float(np.log1p(total)),
            total / float(np.sqrt(words)),
            total / float(1 + np.log(words)),
            max(best.values(), default=0.0),
        ]

    def score(self, rows: list[list[float]]) -> np.ndarray:
        x = np.array(rows, dtype=float).reshape(-1, 4)
        return squash(x @ self.curve[:4] + self.curve[4])


def learn_terms(
    counts: Iterable[tuple[str, int, int]], toxic: int, clean: int, least: int = 4,
    purity: float = 0.75,
) -> dict[str, float]:
    """Terms from (candidate, toxic documents, clean documents), with log odds as weights.

    A term has to occur in ``least`` toxic documents, its share of toxic ones, at equal numbers of
    both kinds, has to reach ``purity``, and its likelihood ratio has to be beyond what chance gives
    among so many candidates. A longer beginning, or a word, is left out if a shorter term already
    covers it as purely.
    """
    counts = [c for c in counts if c[1] >= least]
    rate = toxic / max(1, toxic + clean)
    chance = 2 * np.log(max(1, len(counts))) + 6
    odds: dict[str, float] = {}
    for term, a, b in counts:
        weight = float(np.log((a + 0.1) / (toxic + 0.2)) - np.log((b + 0.5) / (clean + 1.0)))
        ratio = 2 * (a * np.log(a / ((a + b) * rate)) + (b and b * np.log(b / ((a + b) * (1 - rate)))))
        if weight > 0 and squash(np.array(weight)) >= purity and ratio >= chance:
            odds[term] = weight
    kept: dict[str, float] = {}
    for term in sorted(odds, key=lambda t: (len(t), t)):
        weight = odds[term]
        shorter = [term[:k] for k in range(_LEAST + 1, len(term)) if term[:k] in kept]
        if not any(kept[s] >= weight - 0.7 for s in shorter):
            kept[term] = weight
    return kept


def train(
    documents: DataFrame, labels: DataFrame, label: str = "toxic", modulus: int = 5,
    rest: int = 0, rows: int = 20_000, least: int = 4, purity: float = 0.75,
    more_terms: dict[str, float] | None = None, more_exceptions: Iterable[str] = (),
) -> Lexicon:
    """Learn terms, exceptions and the curve from at most ``rows`` labelled documents.

    ``more_terms`` and ``more_exceptions`` add entries by hand; they are folded like texts.
    """
    sample = with_text(documents, training_labels(labels, label, modulus, rest, rows))
    sample = sample.select("y", "text")
    sizes = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    toxic, clean = sizes.get(1, 0), sum(n for y, n in sizes.items() if y != 1)
    found = _count(sample, candidates).where(F.col("toxic") >= least).collect()
    terms = learn_terms([tuple(r) for r in found], toxic, clean, least, purity)
    terms.update({" " + fold(t).strip() + " ": w for t, w in (more_terms or {}).items()})
    lexicon = Lexicon(terms, {fold(p) for p in more_exceptions})
    if not terms or not toxic or not clean:
        lexicon.curve[4] = -4.0 if clean or not toxic else 4.0
        if terms:
            lexicon.curve[:] = (2.0, 0.0, 0.0, 0.0, -2.0)
        return lexicon
    phrases = _count(sample, _phrase_finder(lexicon)).where("clean >= 3").collect()
    rate = toxic / (toxic + clean)
    lexicon.exceptions |= {
        r["term"] for r in phrases
        if r["toxic"] / (r["toxic"] + r["clean"]) <= rate and r["term"] not in terms
    }
    measured = map_texts(
        sample, lambda: _measurer(lexicon), [("x", pa.list_(pa.float64()), "array<double>")]
    ).toPandas()
    x, y = np.array(measured["x"].tolist()), (measured["y"] == 1).to_numpy(float)
    lexicon.curve = fit_logistic(x, y, l2=0.05)
    return lexicon


def _count(sample: DataFrame, pick) -> DataFrame:
    """(term, toxic, clean): documents of each kind, added up inside each task first."""

    def run(batches):
        seen: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for y, text in zip(batch.column("y").to_pylist(), batch.column("text").to_pylist()):
                seen[y == 1].update(pick(fold(text)))
        terms = list(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()),
             pa.array([seen[0][t] for t in terms], pa.int64())],
            names=["term", "toxic", "clean"],
        )

    parts = map_batches(sample, run, "term string, toxic bigint, clean bigint")
    return parts.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _phrase_finder(lexicon: Lexicon):
    """Around each hit: the whole word, and the word with its left or right neighbour."""
    hits = None

    def pick(folded: str) -> set[str]:
        nonlocal hits
        hits = hits or lexicon.matcher()
        found = set()
        for a, _, _ in hits(folded):
            b = folded.index(" ", a + 1) + 1
            found.add(folded[a:b])
            found.add(folded[max(0, folded.rfind(" ", 0, a)) : b])
            found.add(folded[a : (folded.find(" ", b) + 1) or b])
        return found

    return pick


def _measurer(lexicon: Lexicon):
    hits = lexicon.matcher()

    def work(texts: list[str]) -> list[list]:
        folded = [fold(t) for t in texts]
        return [[lexicon.measures(f, hits(f)) for f in folded]]

    return work


def score(
    documents: DataFrame, lexicon: Lexicon, modulus: int = 5, rest: int = 0,
    threshold: float = 0.5,
) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_hits, terms) of every row.

    ``n_hits`` counts matches outside exceptions, ``terms`` lists the distinct ones in order. Null
    texts score as empty ones, without hits. Texts are read whole; repeated rows give repeated
    results; an empty table gives none; a null id counts as held out; other columns are ignored.
    """

    def make():
        hits = lexicon.matcher()

        def work(texts: list[str]) -> list[list]:
            rows, numbers, names = [], [], []
            for t in texts:
                folded = fold(t)
                found = hits(folded)
                rows.append(lexicon.measures(folded, found))
                numbers.append(len(found))
                names.append(sorted({p.strip() for _, _, p in found}))
            return [lexicon.score(rows), numbers, names]

        return work

    rows = documents.select("doc_id", held_out(modulus, rest).alias("held_out"), "text")
    scored = map_texts(
        rows, make,
        [("score", pa.float64(), "double"), ("n_hits", pa.int64(), "bigint"),
         ("terms", pa.list_(pa.string()), "array<string>")],
    )
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_hits", "terms",
    )


def keep_clean(documents: DataFrame, lexicon: Lexicon, threshold: float = 0.5) -> DataFrame:
    """The rows of ``documents`` whose score is below ``threshold``, with all their columns.

    Rows without text are kept. The texts alone go through Python; nothing is joined or shuffled.
    """
    score = text_function(
        documents.sparkSession,
        lambda: (lambda measure: lambda texts: lexicon.score(measure(texts)[0]))(_measurer(lexicon)),
        pa.float64(), "double",
    )
    return documents.where(score(F.col("text")) < threshold)
