"""Subject areas of documents from latent Dirichlet topics.

Each language gets topics of its own over the words of all its documents, fitted by online expectation maximization: a round sends the
topics to the tasks, which infer the proportions of their documents and return the expected counts of words under topics, summed by word. A topic is given the subject
that its top terms point to, as they occur in the labelled documents; a topic whose terms point nowhere has none. Labels serve for nothing else.
A document has the subjects whose topics together reach a share of its topic proportions.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import spread
from .glyphs import glyphs

_WORD = regex.compile(r"[\p{L}][\p{L}\p{M}]+")
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}ー]")
_UNSPACED_RUN = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{M}ー]{2,}")
_PLAIN = regex.compile(r"[^\t\n\r\x20-\x7e]")
_ASCII = regex.compile(r"[a-z]{2,}")


@dataclass(frozen=True)
class Settings:
    """Parameters of the fit and of the assignment. Nothing of the corpus is left out of the fit; ``labels`` bounds the labelled documents that name topics.

    ``topics`` of a language; a term is in at least ``least_docs`` and in the share ``least_share`` of its language's documents, which bounds the terms of a language
    by (different terms of a document) / least_share, and in at most ``most_share`` (``most_share_few`` in a language of few terms); ``rounds`` are made at least and, however large the corpus, about ``rounds`` for one reading
    of it, as parts of at least ``batch`` documents grow with it. ``share`` of a document's topic proportions makes a subject: a sixth of the sentences, of whose words
    some are of topics without subject.
    """

    topics: int = 24
    least_docs: int = 4
    least_share: float = 2e-4
    most_share: float = 0.4
    most_share_few: float = 0.9
    language_docs: int = 20
    rounds: int = 30
    batch: int = 4_000
    steps: int = 12
    doc_prior: float = 0.1
    word_prior: float = 0.05
    delay: float = 2.0
    decay: float = 0.6
    top_terms: int = 30
    lift: float = 2.0
    clear: float = 0.35
    labels: int = 200_000
    share: float = 0.13
    seed: int = 17


def terms(text: str) -> list[str]:
    """Words as they read, in small letters, without numbers; pairs of letters in scripts without blanks."""
    if not _PLAIN.search(text):
        return _ASCII.findall(text.lower())
    seen = glyphs(text).casefold()
    if not _UNSPACED.search(seen):
        return _WORD.findall(seen)
    out = []
    for w in regex.findall(r"[\p{L}\p{M}ー]{2,}", seen):
        if _UNSPACED.search(w):
            for run in _UNSPACED_RUN.findall(w):
                out += [run[i : i + 2] for i in range(len(run) - 1)]
        else:
            out.append(w)
    return out


def with_language(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, text): the two letters of the stated language, empty where none is stated in this form."""
    return docs.select("doc_id", F.regexp_extract(F.lower(F.coalesce("lang", F.lit(""))), r"^\s*([a-z]{2})(?:[-_].*)?\s*$", 1).alias("lang"), "text")


def document_counts(stated: DataFrame) -> DataFrame:
    """(lang, term, n): in how many documents of each stated language a term occurs; the empty term counts the documents with terms. Summed in the tasks before the shuffle."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            counts: Counter = Counter()
            for lang, text in zip(b["lang"], b["text"], strict=True):
                if found := set(terms(text)):
                    counts.update((lang, t) for t in found)
                    counts[lang, ""] += 1
            yield pd.DataFrame([(*k, n) for k, n in counts.items()], columns=["lang", "term", "n"])

    used = stated.where("lang != '' and text is not null").select("lang", "text")
    return used.mapInPandas(run, "lang string, term string, n bigint").groupBy("lang", "term").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Terms of each language, numbered through, and what tells the languages apart."""

    def __init__(self, counts: pd.DataFrame, settings: Settings):
        self.langs: list[str] = []
        self.words: list[dict[str, int]] = []
        self.terms: list[str] = []
        self.topics: list[int] = []
        docs = counts[counts["term"] == ""].set_index("lang")["n"]
        usual: list[dict[str, float]] = []
        for lang, own in counts[counts["term"] != ""].sort_values(["lang", "term"]).groupby("lang"):
            if docs[lang] < settings.language_docs:
                continue
            kept, topics = own[own["n"] <= settings.most_share * docs[lang]], settings.topics
            if len(kept) < 8 * topics:  # a language of few sentences: more of its terms, and fewer topics
                kept = own[own["n"] <= settings.most_share_few * docs[lang]]
                kept = kept if len(kept) >= 8 else own
                topics = max(2, min(topics, len(kept) // 3))
            if len(kept) < topics:
                continue
            self.langs.append(lang)
            self.topics.append(topics)
            self.words.append({t: len(self.terms) + i for i, t in enumerate(kept["term"])})
            self.terms += kept["term"].tolist()
            frequent = own[own["n"] >= 0.02 * docs[lang]]
            usual.append(dict(zip(frequent["term"], (frequent["n"] / docs[lang]).tolist(), strict=True)))
        self.first = np.cumsum([0] + [len(w) for w in self.words])
        self.told: dict[str, np.ndarray] = {}
        for i, u in enumerate(usual):
            for t, share in u.items():
                self.told.setdefault(t, np.full(len(self.langs), np.log(1e-3)))[i] = np.log(share)

    def language(self, found: Counter, stated: str) -> int | None:
        """The language whose documents have such terms; the stated one if nothing tells."""
        rows = [self.told[t] for t in found if t in self.told]
        if rows:
            return int(np.sum(rows, 0).argmax())
        return self.langs.index(stated) if stated in self.langs else None


def document_vectors(stated: DataFrame, vocabulary, settings: Settings, parts: int) -> DataFrame:
    """(doc_id, lang, part, ids, counts) of each document; those without a known term have empty ids. ``lang`` is told by the terms, as the stated one may be wrong or missing."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary.value
        for b in batches:
            rows = []
            for doc_id, stated_, text, part in b.itertuples(index=False, name=None):
                found = Counter(terms(text)) if text else Counter()
                lang = v.language(found, stated_) if found else None
                known = [] if lang is None else [(w, n) for t, n in found.items() if (w := v.words[lang].get(t)) is not None]
                rows.append((doc_id, -1 if lang is None else lang, part, [w for w, _ in known], [n for _, n in known]))
            yield pd.DataFrame(rows, columns=["doc_id", "lang", "part", "ids", "counts"])

    part = F.pmod(F.xxhash64("doc_id", F.lit(settings.seed)), F.lit(parts)).cast("int").alias("part")
    return stated.select("doc_id", "lang", "text", part).mapInPandas(run, "doc_id bigint, lang int, part int, ids array<int>, counts array<int>")


def proportions(ids: np.ndarray, counts: np.ndarray, starts: np.ndarray, phi: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """(of each word its expected counts under topics, of each document its share of each topic) for documents that lie one behind the other, each with a word at least."""
    word = phi[ids]
    sizes = np.diff(np.append(starts, len(ids)))
    theta = np.full((len(starts), phi.shape[1]), 1 / phi.shape[1], np.float32)
    for _ in range(settings.steps):
        each = np.repeat(theta, sizes, 0) * word
        each *= (counts / np.maximum(each.sum(1), 1e-30))[:, None]
        mass = np.add.reduceat(each, starts)
        theta = mass + np.float32(settings.doc_prior)
        theta /= theta.sum(1, keepdims=True)
    return each, mass / mass.sum(1, keepdims=True)


def _by_language(b: pd.DataFrame, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(language, places of its documents in the batch, ids, counts, starts), documents without words left out; in groups, so that a batch of any size fits."""
    sizes = b["ids"].map(len).to_numpy()
    for lang in range(n):
        own = np.flatnonzero((b["lang"].to_numpy() == lang) & (sizes > 0))
        while len(own):
            take = max(1, int(np.searchsorted(np.cumsum(sizes[own]), 200_000)))
            at, own = own[:take], own[take:]
            yield lang, at, np.concatenate(b["ids"].to_numpy()[at]), np.concatenate(b["counts"].to_numpy()[at]).astype(np.float32), np.concatenate([[0], np.cumsum(sizes[at])[:-1]])


def parts_of(n_docs: int, settings: Settings) -> int:
    """Parts that the documents are dealt into: of about ``batch`` documents, larger ones where there would be more parts than rounds."""
    return max(1, min(settings.rounds, round(n_docs / settings.batch)))


def rounds_of(parts: int, settings: Settings) -> int:
    """Rounds in which each part is read as often as any other, and at least once."""
    return parts * max(1, round(settings.rounds / parts))


def fit_topics(vectors: DataFrame, vocabulary: Vocabulary, sent, parts: int, settings: Settings) -> list[np.ndarray]:
    """Of each language, the expected counts of its words (rows) under its topics, from rounds over parts of all documents.

    Nothing but sums by word comes to the driver: no more rows than the vocabulary has, which its settings bound.
    """
    spark = vectors.sparkSession
    rng = np.random.default_rng(settings.seed)
    sums = [rng.gamma(100.0, 0.01, (len(w), k)).astype(np.float32) for w, k in zip(vocabulary.words, vocabulary.topics, strict=True)]
    n_docs = {r.lang: r.n for r in vectors.where(F.size("ids") > 0).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    most = max(vocabulary.topics)
    names = [f"t{i}" for i in range(most)]
    for step in range(rounds_of(parts, settings)):
        known = spark.sparkContext.broadcast([(s + settings.word_prior) / (s + settings.word_prior).sum(0) for s in sums])

        def run(batches: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            first = sent.value.first
            got = [np.zeros((first[i + 1] - first[i], p.shape[1]), np.float32) for i, p in enumerate(known.value)]
            docs = np.zeros(len(got))
            for b in batches:
                for lang, at, ids, counts, starts in _by_language(b, len(got)):
                    own = ids - first[lang]
                    each, _ = proportions(own, counts, starts, known.value[lang], settings)
                    order = np.argsort(own, kind="stable")
                    heads = np.flatnonzero(np.diff(own[order], prepend=-1))
                    got[lang][own[order][heads]] += np.add.reduceat(each[order], heads)
                    docs[lang] += len(at)
            for lang, g in enumerate(got):
                if docs[lang]:
                    some = np.flatnonzero(g.any(1))
                    rows = np.zeros((len(some) + 1, most), np.float32)
                    rows[:-1, : g.shape[1]] = g[some]
                    rows[-1, 0] = docs[lang]  # under a word below zero, the documents
                    yield pd.DataFrame(rows, columns=names).assign(word=np.append(some + first[lang], -1 - lang).astype(np.int32))[["word", *names]]

        some = vectors.where(F.col("part") == step % parts) if parts > 1 else vectors
        stats = some.select("lang", "ids", "counts").mapInPandas(run, "word int, " + ", ".join(f"{n} float" for n in names))
        total = stats.groupBy("word").agg(*[F.sum(n).cast("float").alias(n) for n in names]).toArrow()
        word = total["word"].to_numpy()
        values = np.stack([total[n].to_numpy() for n in names], 1) if len(word) else np.zeros((0, most), np.float32)
        rate = (settings.delay + step) ** -settings.decay if parts > 1 else 1.0
        for lang, s in enumerate(sums):
            if (here := values[word == -1 - lang, 0]).size:
                own = (word >= vocabulary.first[lang]) & (word < vocabulary.first[lang + 1])
                fresh = np.zeros_like(s)
                fresh[word[own] - vocabulary.first[lang]] = values[own, : s.shape[1]]
                sums[lang] = (1 - rate) * s + rate * fresh * (n_docs[lang] / here[0])
        known.unpersist()
    return sums


def support(vectors: DataFrame, known: DataFrame) -> pd.DataFrame:
    """(word, subject_id, weight): in how many labelled documents of each subject a word occurs; a document of m subjects counts 1 / m for each."""
    per = known.groupBy("doc_id").agg(F.collect_set("subject_id").alias("subjects"))
    one = vectors.where(F.size("ids") > 0).join(per, "doc_id").select("ids", F.explode("subjects").alias("subject_id"), F.size("subjects").alias("m"))
    return one.select(F.explode("ids").alias("word"), "subject_id", "m").groupBy("word", "subject_id").agg(F.sum(1 / F.col("m")).alias("weight")).toPandas()


@dataclass
class Model:
    """Of each language the probabilities of its words under its topics, and the place of each topic's subject (none: -1); with the top terms for inspection."""

    phi: list[np.ndarray]
    topic_subjects: list[np.ndarray]
    subjects: list[int]
    top: list[list[list[str]]]


def describe(sums: list[np.ndarray], vocabulary: Vocabulary, seen: pd.DataFrame, prior: dict[int, float], settings: Settings) -> Model:
    """Names the topics: by the share of each subject in the labelled documents of their top terms, if it is clear and well above the subject's own share."""
    subjects = sorted(prior)
    base = np.array([prior[s] for s in subjects]) + 1
    base /= base.sum()
    weights = np.zeros((len(vocabulary.terms), len(subjects)))
    if len(seen):
        weights[seen["word"].to_numpy(), [subjects.index(s) for s in seen["subject_id"]]] = seen["weight"].to_numpy(float)
    shares = (weights + base) / (weights.sum(1, keepdims=True) + 1)
    phis, named, tops = [], [], []
    for lang, s in enumerate(sums):
        phi = (s + settings.word_prior) / (s + settings.word_prior).sum(0)
        overall = phi @ (s.sum(0) / max(s.sum(), 1e-30))
        names = np.full(phi.shape[1], -1)
        top = []
        for t in range(phi.shape[1]):
            score = phi[:, t] * np.log(np.maximum(phi[:, t], 1e-12) / np.maximum(overall, 1e-12))
            best = np.argsort(-score, kind="stable")[: settings.top_terms]
            w = np.maximum(score[best], 0)
            points = (w[:, None] * shares[best + vocabulary.first[lang]]).sum(0) / max(w.sum(), 1e-12)
            i = int(np.argmax(points / base))
            if points[i] >= max(settings.lift * base[i], settings.clear):
                names[t] = i
            top.append([vocabulary.terms[vocabulary.first[lang] + j] for j in best[:12]])
        phis.append(phi.astype(np.float32))
        named.append(names)
        tops.append(top)
    return Model(phis, named, subjects, tops)


def assign(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, subject_id, share) of every document, labelled or not: the subjects with at least ``settings.share`` of its topic proportions.

    Null, empty and blank texts, and those without a word of any topic, have none. Repeated rows are judged each. Without labels there are no subjects: no
    rows. Texts are read twice, for the counts and for the vectors, which are kept on the executors for the rounds.
    """
    spark = docs.sparkSession
    nothing = spark.createDataFrame([], "doc_id bigint, subject_id bigint, share double")
    known = labels.where("doc_id is not null and subject_id is not null").select("doc_id", "subject_id").distinct()
    n_labelled = known.select("doc_id").distinct().count()
    if not n_labelled:
        return nothing
    if n_labelled > settings.labels:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * settings.labels / n_labelled))
    known = known.persist(StorageLevel.MEMORY_AND_DISK)
    prior = {int(r.subject_id): r.n for r in known.groupBy("subject_id").agg(F.count("*").cast("double").alias("n")).collect()}
    stated = with_language(spread(docs.select("doc_id", "lang", "text")))
    counts = document_counts(stated).persist(StorageLevel.MEMORY_AND_DISK)
    sizes = counts.where("term = ''").select("lang", F.col("n").alias("docs"))
    often = F.greatest(F.lit(settings.least_docs), settings.least_share * F.col("docs"))
    vocabulary = Vocabulary(counts.join(F.broadcast(sizes), "lang").where((F.col("term") == "") | (F.col("n") >= often)).select("lang", "term", "n").toPandas(), settings)
    n_docs = sizes.agg(F.sum("docs").alias("n")).head().n or 0
    counts.unpersist()
    if not vocabulary.langs:
        return nothing
    sent = spark.sparkContext.broadcast(vocabulary)
    parts = parts_of(n_docs, settings)
    vectors = document_vectors(stated, sent, settings, parts).persist(StorageLevel.MEMORY_AND_DISK)
    sums = fit_topics(vectors, vocabulary, sent, parts, settings)
    model = spark.sparkContext.broadcast(describe(sums, vocabulary, support(vectors, known), prior, settings))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, first = model.value, sent.value.first
        for b in batches:
            ids_, out = b["doc_id"].to_numpy(), []
            for lang, at, ids, counts_, starts in _by_language(b, len(m.phi)):
                _, theta = proportions(ids - first[lang], counts_, starts, m.phi[lang], settings)
                share = np.zeros((len(at), len(m.subjects)))
                for t, s in enumerate(m.topic_subjects[lang]):
                    if s >= 0:
                        share[:, s] += theta[:, t]
                d, s = np.nonzero(share >= settings.share)
                out.append(pd.DataFrame({"doc_id": ids_[at[d]], "subject_id": np.array(m.subjects)[s], "share": share[d, s]}))
            yield pd.concat(out) if out else pd.DataFrame({"doc_id": [], "subject_id": [], "share": []})

    return vectors.select("doc_id", "lang", "ids", "counts").mapInPandas(run, "doc_id bigint, subject_id bigint, share double")


def unlabelled(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(doc_id, subject_id), once each, of the documents without a label."""
    out = assign(docs, labels, settings).select("doc_id", "subject_id").distinct()
    return out.join(labels.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_anti")


def composition(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(subject_id, documents, mean_share): how much of the corpus each subject has."""
    return assign(docs, labels, settings).groupBy("subject_id").agg(F.countDistinct("doc_id").alias("documents"), F.avg("share").alias("mean_share"))
