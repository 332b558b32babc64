"""Toxicity of texts by weak supervision: many voters, a label model over them, a linear classifier on its labels.

**Voters.**  A voter looks at a text and fires or not.  Lexicon voters count words of a lexicon: one public list of insults,
and lists of whole words and of word beginnings (3 to 7 letters) that texts labelled toxic use more than others,
each in a strong and a medium half.  Pattern voters look for an insult near a word of address, shouting, repeated
marks and masked words.  What a text uses is measured in shares of its words, so that long texts don't fire by chance.

**Label model.**  A generative model of one hidden class and all votes: each voter fires with its own strength in either
class (its accuracy), and pairs of voters that agree more or less than the class explains have a correlation of
their own.  A given label is one more, noisy witness of the class, whose error rate is estimated, too.  The model
is fitted by expectation-maximisation on the counts of vote patterns over all documents; with V voters there are at
most 2^V patterns, over which all sums are exact.

**Classifier.**  A logistic regression on the lexicon words, word beginnings, lexicon shares and votes of a
text, trained on the posterior classes of about ``sample_docs`` documents (a documented bound, 30 000, drawn by
a hash of the id among those whose labels may be learned from).  Its lexicon is fitted on about ``train_texts`` different
labelled texts (60 000, drawn by a hash, the rarer class up to half of them) and keeps at most ``lexicon`` entries (the
size of the classifier, 20 000), the surest first.  Votes, their patterns and the label model cover all documents,
and every text is scored whole.

As lexicons are counted over different texts, a large group of copies weighs as one.
Null and empty texts have no word and get the classifier's base score.  Without any label to learn from, only
the public list and the patterns vote.  Documents without an id are scored, but nothing is learned from them.  Repeated rows
give repeated results; several labels of one document count as their mean; null labels as none; other columns do not matter.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from residua.llm.words import in_pieces, utf8
from residua.session import stored

SAMPLE_DOCS = 30_000
TRAIN_TEXTS = 60_000
LEXICON = 20_000
LEAST_TEXTS = 5  # toxic texts that a lexicon entry must stand in
STRONG, MEDIUM = 3.0, 1.5  # least log ratio of a lexicon entry's shares
SURE = 3.0  # least log ratio in standard errors
DENSE = 50  # a word in every so many of a text is a full share
PREFIXES = range(3, 8)
LONGEST_WORD = 40
CHUNK = 2_000_000
FLUSH = 150_000
REMEMBERED = 200_000

LETTERS = bytes(b for b in range(256) if 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
#: Every byte of a UTF-8 text: itself if part of a word, else a space.
SPLIT = bytes(b if b in LETTERS else 32 for b in range(256))
NO_LETTERS = bytes(set(range(256)) - set(LETTERS))
NO_CAPITALS = bytes(set(range(256)) - set(range(65, 91)))
MASKED = re.compile(r"[A-Za-z][*#@$%]{2,}[A-Za-z]")
NO_MASKS = bytes(set(range(256)) - set(b"*#@$%"))
MARKS = re.compile(r"[!?]{3,}")

# Public words of insult and of address.
INSULTS = frozenset(
    "asshole bastard bitch clown cretin dumb filth fool idiot imbecile jerk loser moron pathetic scum stupid trash worthless "
    "arschloch blödmann depp dummkopf idioten miststück schwein trottel vollidiot wichser "
    "abruti bouffon connard connasse crétin débile imbécile ordure salaud salope "
    "basura cabrón estúpido estúpida gilipollas idiota imbécil inútil pendejo puta".split()
)
ADDRESS = frozenset("you your youre du dich dein ihr tu toi vous votre tú usted eres".split())

FAMILIES = ("word", "short", "middle", "long")  # whole words, and beginnings of 3 or 4, 5, 6 or 7 letters
VOTERS = (
    *(f"{family}_{half}" for family in FAMILIES for half in ("strong", "medium")),
    "public_list",
    "addressed_insult",
    "shouting",
    "marks_or_masks",
)


def family(entry: str) -> str:
    if entry[0] == "=":
        return "word"
    return "short" if len(entry) <= 5 else "middle" if len(entry) == 6 else "long"


def word_list(text: str) -> list[bytes]:
    """Runs of letters (every character beyond ASCII counts as one), lower-cased, as UTF-8."""
    return utf8(text.lower()).translate(SPLIT).split()


def entries(word: str) -> list[str]:
    """What a lexicon may hold of a word."""
    found = ["^" + word[:k] for k in PREFIXES if len(word) >= k]
    return found + ["=" + word] if len(word) <= LONGEST_WORD else found


# --- lexicons


def lexicon_counts(texts: DataFrame) -> DataFrame:
    """``(entry, toxic_share, toxic_texts, other_share, other_texts)`` from ``(text, toxic)``; shares in thousandths.

    Words are counted per text and summed up before they are shuffled; their beginnings are summed from the words.
    A text counts once for every different word that an entry covers in it.
    """
    sums = ["toxic_share", "toxic_texts", "other_share", "other_texts"]

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals: dict[bytes, list[int]] = {}

        def frame() -> pd.DataFrame:
            return pd.DataFrame([(k.decode("utf-8", "replace"), *v) for k, v in totals.items()], columns=["word", *sums])

        for batch in batches:
            for text, toxic in zip(batch["text"], batch["toxic"]):
                words = word_list(text)
                size, at = len(words), 0 if toxic else 2
                for word, n in Counter(words).items():
                    row = totals.get(word)
                    if row is None:
                        row = totals[word] = [0, 0, 0, 0]
                    row[at] += min(1000, 1000 * DENSE * n // size)
                    row[at + 1] += 1
                if len(totals) > FLUSH:
                    yield frame()
                    totals = {}
        if totals:
            yield frame()

    parts = texts.mapInPandas(counted, "word string, " + ", ".join(f"{c} long" for c in sums))
    words = parts.groupBy("word").agg(*[F.sum(c).alias(c) for c in sums])
    letters = F.char_length("word")
    of = [F.when(letters <= LONGEST_WORD, F.concat(F.lit("="), "word"))]
    of += [F.when(letters >= k, F.concat(F.lit("^"), F.substring("word", 1, k))) for k in PREFIXES]
    listed = words.select(F.explode(F.array_compact(F.array(*of))).alias("entry"), *sums)
    return listed.groupBy("entry").agg(*[F.sum(c).alias(c) for c in sums])


def _drawn(heads: DataFrame, most: int) -> DataFrame:
    """About ``most`` of the rows ``(id, same, toxic)``, at most half of them of one class, by a hash."""
    counts = {r["toxic"]: r["n"] for r in heads.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    rare = min(counts.values(), default=0)
    wanted = {toxic: max(most // 2, most - rare) if n > rare else most // 2 for toxic, n in counts.items()}
    bound = F.lit(0.0)
    for toxic, n in counts.items():
        bound = F.when(F.col("toxic") == toxic, float((1 << 30) * wanted[toxic]) / n).otherwise(bound)
    return heads.where(F.pmod(F.xxhash64("same", "id"), F.lit(1 << 30)) < bound)


def learned_lexicon(texts: DataFrame, chosen: DataFrame, most: int) -> dict[str, float]:
    """Entries that toxic texts use more, with the log ratio of their mean shares; ``chosen`` has a row per text."""
    sizes = {bool(r["toxic"]): r["n"] for r in chosen.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not sizes.get(True) or not sizes.get(False):
        return {}
    toxic = (F.col("toxic_share") + 500) / F.lit(1000.0 * sizes[True])
    other = (F.col("other_share") + 500) / F.lit(1000.0 * sizes[False])
    error = F.sqrt(1 / (F.col("toxic_texts") + 0.5) + 1 / (F.col("other_texts") + 0.5))
    rated = lexicon_counts(texts).withColumn("ratio", F.log(toxic / other)).withColumn("sure", F.col("ratio") / error)
    good = rated.where((F.col("toxic_texts") >= LEAST_TEXTS) & (F.col("ratio") >= MEDIUM) & (F.col("sure") >= SURE))
    kept = good.orderBy(F.desc("sure"), "entry").limit(most)
    return {r["entry"]: r["ratio"] for r in kept.select("entry", "ratio").collect()}


# --- what a text shows


class Reader:
    """Votes and features of texts; remembers words, up to a bound."""

    def __init__(self, lexicon: dict[str, float]):
        self.place = {entry: i for i, entry in enumerate(lexicon)}
        lists = [f"{f}_{h}" for f in FAMILIES for h in ("strong", "medium")]
        self.lists = {e: lists.index(f"{family(e)}_{'strong' if r >= STRONG else 'medium'}") for e, r in lexicon.items()}
        self.n_lists = len(lists)
        #: The first three bytes of every word that any list may hold.
        self.heads = {w.encode()[:3] for w in (*(e[1:] for e in lexicon), *INSULTS)}
        self.known: dict[bytes, tuple[list[int], set[int], bool]] = {}

    @property
    def size(self) -> int:
        """Number of features: entries, shares of lists, votes."""
        return len(self.place) + self.n_lists + len(VOTERS)

    def _look(self, word: bytes) -> tuple[list[int], set[int], bool]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        plain = word.decode("utf-8", "replace")
        found = [e for e in entries(plain) if e in self.place]
        look = [self.place[e] for e in found], {self.lists[e] for e in found}, plain in INSULTS
        self.known[word] = look
        return look

    def read(self, text: str | None) -> tuple[int, list[int], list[float]]:
        """The votes as bits, and places and values of the features that are not 0."""
        text = text or ""
        words = word_list(text)
        size, heads = max(1, len(words)), self.heads
        uses: dict[int, int] = {}
        hits = [0] * self.n_lists
        public = 0
        for word in [w for w in words if w[:3] in heads]:
            places, lists, insult = self.known.get(word) or self._look(word)
            for place in places:
                uses[place] = uses.get(place, 0) + 1
            for i in lists:
                hits[i] += 1
            public += insult
        votes = [h * (250 if i % 2 == 0 else 100) >= size for i, h in enumerate(hits)]
        votes += [public * 250 >= size, bool(public) and self._addressed(words), *self._marked(text)]
        base = len(self.place)
        at = sorted(uses)
        values = [min(1.0, DENSE * uses[i] / size) for i in at]
        for i, h in enumerate(hits):
            if h:
                at.append(base + i)
                values.append(min(1.0, DENSE * h / size))
        base += self.n_lists
        bits = 0
        for i, vote in enumerate(votes):
            if vote:
                bits |= 1 << i
                at.append(base + i)
                values.append(1.0)
        return bits, at, values

    @staticmethod
    def _addressed(words: list[bytes]) -> bool:
        plain = [w.decode("utf-8", "replace") for w in words]
        places = [i for i, w in enumerate(plain) if w in INSULTS]
        return any(w in ADDRESS for i in places for w in plain[max(0, i - 3) : i + 4])

    @staticmethod
    def _marked(text: str) -> tuple[bool, bool]:
        """Shouting; repeated marks or masked words."""
        raw = utf8(text)
        capitals = len(raw.translate(None, NO_CAPITALS))
        shouts = capitals >= 10 and 2 * capitals > len(raw.translate(None, NO_LETTERS))
        if any(m in text for m in ("!!", "??", "!?", "?!")) and MARKS.search(text):
            return shouts, True
        return shouts, len(raw.translate(None, NO_MASKS)) > 1 and bool(MASKED.search(text))


def read_all(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``(id, held_out, learnable, votes, at, values)`` of rows ``(id, held_out, learnable, text)``."""
    sent = docs.sparkSession.sparkContext.broadcast(lexicon)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(sent.value)
        for batch in batches:
            for s in in_pieces(batch["text"], CHUNK):
                part = batch.iloc[s]
                seen = [reader.read(t) for t in part["text"]]
                columns = {"votes": [v for v, _, _ in seen], "at": [a for _, a, _ in seen], "values": [x for _, _, x in seen]}
                yield part[["id", "held_out", "learnable"]].assign(**columns)

    # ids travel as text: pandas would turn whole numbers beside a null into doubles
    rows = docs.withColumn("id", F.col("id").cast("string"))
    schema = "id string, held_out boolean, learnable boolean, votes int, at array<int>, values array<double>"
    return rows.mapInPandas(read, schema)


# --- the label model


@dataclass
class LabelModel:
    """``accuracy[y, j]``: log odds-like strength of voter j in class y; ``correlation`` of the listed ``pairs``."""

    prior: float
    accuracy: np.ndarray
    pairs: list[tuple[int, int]]
    correlation: np.ndarray
    label_error: float

    @property
    def voters(self) -> int:
        return self.accuracy.shape[1]

    def log_chance(self) -> np.ndarray:
        """log P(votes | class) of all vote patterns: classes x 2^V."""
        states, products = _states(self.voters, self.pairs)
        energy = self.accuracy @ states.T + self.correlation @ products.T
        return energy - _logsum(energy)[:, None]

    def fires(self) -> np.ndarray:
        """P(voter fires | class): classes x V."""
        return np.exp(self.log_chance()) @ _states(self.voters, [])[0]

    def posterior(self, votes: np.ndarray, label: np.ndarray) -> np.ndarray:
        """P(class 1 | votes, label); label -1: none."""
        return _posterior(self.log_chance(), self.prior, self.label_error, votes, label)


def _states(voters: int, pairs: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    states = ((np.arange(1 << voters)[:, None] >> np.arange(voters)) & 1).astype(float)
    products = np.stack([states[:, j] * states[:, k] for j, k in pairs], axis=1) if pairs else np.zeros((len(states), 0))
    return states, products


def _logsum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None]).sum(axis=1))


def _posterior(log_chance, prior, error, votes, label) -> np.ndarray:
    odds = math.log(prior / (1 - prior)) + log_chance[1, votes] - log_chance[0, votes]
    odds = odds + np.where(label < 0, 0.0, np.where(label == 1, 1.0, -1.0) * math.log((1 - error) / error))
    return 1 / (1 + np.exp(-np.clip(odds, -700, 700)))


def _maximised(states, products, mass, start: np.ndarray, rounds: int = 8) -> np.ndarray:
    """Newton steps for the strengths, given the expected mass of every pattern in either class."""
    v, c = states.shape[1], products.shape[1]
    theta, whole = start.copy(), np.concatenate([states, products], axis=1)
    for _ in range(rounds):
        gradient, curve = -theta.copy(), np.eye(2 * v + c)  # a weak prior keeps silent voters finite
        for y in (0, 1):
            where = np.concatenate([np.arange(y * v, y * v + v), np.arange(2 * v, 2 * v + c)])
            energy = whole @ theta[where]
            chance = np.exp(energy - energy.max())
            chance /= chance.sum()
            mean, total = chance @ whole, mass[y].sum()
            gradient[where] += mass[y] @ whole - total * mean
            curve[np.ix_(where, where)] += total * ((whole * chance[:, None]).T @ whole - np.outer(mean, mean))
        step = np.linalg.solve(curve, gradient)
        theta += step * min(1.0, 4.0 / max(4.0, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return theta


def fit_label_model(
    votes: np.ndarray, label: np.ndarray, count: np.ndarray, voters: int = len(VOTERS), rounds: int = 25, related: float = 0.1
) -> LabelModel:
    """From counts of (vote pattern, label) rows; label -1: none.  Pairs whose votes correlate by more than
    ``related`` within the classes get a strength of their own."""
    if not len(votes):
        return LabelModel(0.5, np.zeros((2, voters)), [], np.zeros(0), 0.02)
    count = count * min(1.0, 1e5 / max(1.0, count.sum()))
    given = label >= 0
    bits = _states(voters, [])[0][votes]
    if (count * (label == 1)).sum() > 0 and (count * (label == 0)).sum() > 0:
        belief = np.where(given, label == 1, (bits.sum(axis=1) >= 2) * 0.5).astype(float)
    else:
        belief = np.clip(bits.sum(axis=1) / 3, 0.02, 0.98)
    weight = np.where(given, count, 0.0) if given.any() else count
    prior, error = float(np.clip((weight * belief).sum() / max(weight.sum(), 1e-9), 0.001, 0.5)), 0.02
    pairs: list[tuple[int, int]] = []
    states, products = _states(voters, pairs)
    theta = np.zeros(2 * voters)
    start = weight  # the first step learns from labels alone where there are any

    def mass_of(weight, belief):
        return np.stack([np.bincount(votes, weight * (1 - belief), len(states)), np.bincount(votes, weight * belief, len(states))])

    for i in range(2 * rounds):
        theta = _maximised(states, products, mass_of(start, belief), theta)
        start = count
        model = LabelModel(prior, theta[: 2 * voters].reshape(2, voters), pairs, theta[2 * voters :], error)
        belief = model.posterior(votes, label)
        prior = float(np.clip((count * belief).sum() / count.sum(), 0.001, 0.5))
        if given.any():
            wrong = np.where(label == 1, 1 - belief, belief)
            error = float(np.clip((count * wrong)[given].sum() / count[given].sum(), 0.001, 0.2))
        if i == rounds - 1:
            pairs = _related(bits, count, belief, related)
            states, products = _states(voters, pairs)
            theta = np.concatenate([theta, np.zeros(len(pairs))])
    return LabelModel(prior, theta[: 2 * voters].reshape(2, voters), pairs, theta[2 * voters :], error)


def _related(bits, count, belief, least: float) -> list[tuple[int, int]]:
    """Pairs of voters that the class alone does not explain."""
    spread = np.zeros((bits.shape[1],) * 2)
    for share in (count * (1 - belief), count * belief):
        centred = bits - share @ bits / max(share.sum(), 1e-9)
        spread += (centred * share[:, None]).T @ centred
    size = np.sqrt(np.maximum(np.diag(spread), 1e-9))
    return [(j, k) for j, k in combinations(range(bits.shape[1]), 2) if abs(spread[j, k]) > least * size[j] * size[k]]


# --- the classifier


def fit_linear(
    at: list, values: list, target: np.ndarray, size: int, rounds: int = 400, rate: float = 0.1, shrink: float = 2e-5
) -> tuple[np.ndarray, float]:
    """Weights and base of a logistic regression on sparse rows, by Adam on all of them."""
    lengths = np.array([len(a) for a in at], np.int64)
    row = np.repeat(np.arange(len(at)), lengths)
    column = np.concatenate([np.zeros(0, np.int64), *[np.asarray(a, np.int64) for a in at]])
    x = np.concatenate([np.zeros(0), *[np.asarray(v, float) for v in values]])
    share = float(np.clip(target.mean() if len(target) else 0.0, 1e-3, 1 - 1e-3))
    w = np.zeros(size + 1)
    w[-1] = math.log(share / (1 - share))
    m, s = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, rounds + 1 if len(target) else 1):
        z = np.bincount(row, x * w[column], len(at)) + w[-1]
        away = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - target
        g = np.append(np.bincount(column, x * away[row], size), away.sum()) / len(at)
        g[:-1] += shrink * w[:-1]
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


@dataclass
class Toxicity:
    lexicon: dict[str, float]
    labels: LabelModel
    weights: np.ndarray
    base: float

    def score(self, at, values) -> float:
        z = self.base + float(self.weights[np.asarray(at, np.int64)] @ np.asarray(values, float)) if len(at) else self.base
        return 1 / (1 + math.exp(-min(max(z, -700.0), 700.0)))


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    held_out: str = "FALSE",
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_docs: int = SAMPLE_DOCS,
    train_texts: int = TRAIN_TEXTS,
    lexicon: int = LEXICON,
) -> tuple[DataFrame, Toxicity]:
    """``(doc_id, held_out, score, predicted)`` per row, and the model.

    ``held_out`` is a SQL condition on ``docs``: labels of documents for which it holds are not looked at.
    """
    out = F.coalesce(F.expr(held_out), F.lit(False))
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).alias("text"),
        out.alias("held_out"),
        (~out & F.col(id_col).isNotNull()).alias("learnable"),
    )
    known = labels.where(F.col(label_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
    known = known.agg((F.avg(label_col) >= 0.5).alias("toxic"))
    same = F.xxhash64("text").alias("same")
    readable = rows.where("learnable AND text IS NOT NULL")
    # one row for each different text, whatever the number of its copies; only ids and hashes are shuffled
    heads = readable.select("id", same).join(known, "id").groupBy("same")
    heads = heads.agg(F.min("id").alias("id"), (F.avg(F.col("toxic").cast("int")) >= 0.5).alias("toxic"))
    chosen = stored(_drawn(stored(heads, "toxic-heads"), train_texts), "toxic-texts")
    # at most about ``train_texts`` rows of 17 bytes: a megabyte by their bound, so the texts stay where they are
    texts = readable.select("id", "text", same).join(F.broadcast(chosen), ["id", "same"]).select("text", "toxic")
    words = learned_lexicon(texts, chosen, lexicon)

    seen = stored(read_all(rows, words), "toxic-features")
    given = known.select(F.col("id").cast("string").alias("id"), F.col("toxic").cast("int").alias("label"))
    voted = seen.select("id", "learnable", "votes").join(given, "id", "left")
    label = F.when(F.col("learnable"), F.coalesce("label", F.lit(-1))).otherwise(-1)
    patterns = voted.groupBy("votes", label.alias("label")).agg(F.count("*").alias("n")).orderBy("votes", "label").toPandas()
    model = fit_label_model(patterns["votes"].to_numpy(np.int64), patterns["label"].to_numpy(), patterns["n"].to_numpy(float))

    learnable = seen.where("learnable")
    total = learnable.count()
    drawn = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < F.lit(float((1 << 30) * sample_docs) / max(1, total))
    sample = learnable.where(drawn).join(given, "id", "left").orderBy("id", "votes")
    sample = sample.select("votes", F.coalesce("label", F.lit(-1)).alias("label"), "at", "values").toPandas()
    target = model.posterior(sample["votes"].to_numpy(np.int64), sample["label"].to_numpy())
    weights, base = fit_linear(list(sample["at"]), list(sample["values"]), target, Reader(words).size)
    fitted = Toxicity(words, model, weights, base)
    sent = docs.sparkSession.sparkContext.broadcast(fitted)

    @F.pandas_udf("double")
    def score(at: pd.Series, values: pd.Series) -> pd.Series:
        return pd.Series([sent.value.score(a, v) for a, v in zip(at, values)], dtype=float)

    scored = seen.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "held_out", score("at", "values").alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")), fitted
