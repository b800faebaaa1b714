"""Toxicity: Levenshtein automata over a lexicon trie, context windows that tell quotation from abuse."""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import crc_mod, saved, table
from .textbytes import text_runs

#: Common English insults, from which the lexicon starts. Labels add terms and set weights.
SEED_TERMS = (
    "clown", "disgusting", "dumb", "filth", "fool", "garbage", "idiot", "imbecile", "jerk", "loser", "moron", "pathetic",
    "scum", "stupid", "trash", "vermin", "worthless",
)
BY_DISTANCE = (1.0, 0.9, 0.8)
#: Bytes before and after a hit, in its line, that are looked at for the words below.
WINDOW = 64
#: Nouns that announce a term, verbs of speech and words for who is spoken to, in English, German, French and Spanish.
NOUNS = frozenset((
    "word", "words", "term", "slur", "insult", "definition", "wort", "wörter", "begriff", "ausdruck", "schimpfwort", "mot", "mots", "terme", "insulte",
    "palabra", "palabras", "término", "insulto",
))
SPEECH = frozenset((
    "said", "says", "wrote", "called", "calls", "quote", "quoted", "shouted", "sagte", "sagten", "schrieb", "schrieben", "nannte", "nannten", "rief", "riefen",
    "dit", "écrit", "écrivit", "appelé", "dijo", "escribió", "llamó", "llamaron", "gritó",
))
PERSON = frozenset(("you", "your", "u", "ur", "du", "dich", "dir", "dein", "ihr", "tu", "toi", "te", "vous", "eres", "tú", "usted", "ustedes"))
#: Who may stand between a verb of speech and a term, with an article; words that turn a noun above into a turn of phrase ("in a word").
OTHERS = frozenset(("him", "her", "them", "ihn", "ihm", "ihnen"))
ARTICLES = frozenset(("a", "an", "the", "ein", "eine", "einen", "un", "une", "una"))
TURNS = frozenset(("in", "mit", "en"))
#: Words of a quotation that may stand for quotation marks of irony, and words beside a term that are looked at for who is spoken to.
SCARE_WORDS, BESIDE = 2, 3
#: Where the window's weights start from before labels are seen: a line with a term that is quoted or mentioned, or not.
QUOTING = (
    'she wrote "{}" in the report', "the word {} is rude", "the term {} means nothing", "a slur like “{}” is banned", '"you {}" was what he shouted',
    "er schrieb „{}“ darunter", "das Wort {} gilt als grob", "der Begriff „{}“ fiel", "il a écrit « {} » hier", "le mot {} est grossier", "on lit « {} » au mur",
    "la palabra {} es ofensiva", "escribió «{}» en la nota", "the insult '{}' was used", "they called it '{}'", "definition of {}", "the word “{}”", 'quoted: "{}"',
    "she called him a {}", "er nannte ihn einen {}", 'nobody shouted "{}" today', "«{}» se lee en la pared",
)
ABUSING = (
    "you {}", "you are a {}", "I said you {}", "they called you an {}", "words fail me {}", "what a {} he is", "such {} people", "go away {}", "{} that you are",
    "du bist ein {}", "ihr seid {}", "so ein {}", "tu es un {}", "quel {}", "vous êtes {}", "eres un {}", "qué {}", "he said that and he is a {}", "a word from you {}",
    "they are {} all of them", "this {} wrote it", "shut up {}", "with a word {}", "en un mot {}",
    'your "{}" of a brother', "what “{}” you are", "du „{}“ du", "ihr seid „{}“", "toi, espèce de « {} »", "tú «{}»",
)
#: Bytes of text that are looked at at once.
RUN_BYTES = 1 << 19
#: Constant and coefficients (strongest hit, log of the sum of hits) before labels are seen.
PRIOR = (-4.0, 1.8, 0.8)

_LETTERS = np.zeros(128, bool)
_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_INNER = np.zeros(128, bool)
_INNER[[ord(c) for c in "@$!*#_"]] = True  # stand in for a letter between two letters


def allowed_distance(term: str) -> int:
    """Edits that a term bears: one for each five letters, two at most. A stem ("term*": any word that begins so) bears none: tried with one
    from seven letters on, held-out precision on sf0.1 fell from 0.95 to 0.86, as other words of the language lie that near."""
    return 0 if term.endswith("*") else min(len(term) // 5, 2)


@dataclass
class Automaton:
    """A table over letters: step[state, letter] is the next state, 0 is dead, 1 the start; term and distance where a state accepts.

    Letters up to 127 are ASCII, then come the others of the terms, by extra; 0 stands for all that no term has.
    """

    terms: list[str]
    extra: dict[int, int]
    step: np.ndarray
    term: np.ndarray
    distance: np.ndarray
    longest: int


def build_automaton(terms: list[str]) -> Automaton:
    """The product of the lexicon's trie and the Levenshtein automata of its terms, made deterministic.

    A state is a set of (trie node, edits so far); a node with fewer edits covers itself with more.
    The node where a stem ends stays in the set whatever follows. Each term has its own bound of edits, by its length, so nodes carry the largest bound below them.
    """
    children, end, most, stems = [{}], [-1], [0], set()
    extra = {c: 128 + i for i, c in enumerate(sorted({ord(ch) for term in terms for ch in term if ord(ch) > 127}))}
    for t, term in enumerate(terms):
        node, bound = 0, allowed_distance(term)
        most[0] = max(most[0], bound)
        for ch in map(ord, term.removesuffix("*")):
            ch = extra.get(ch, ch)
            if ch not in children[node]:
                children[node][ch] = len(children)
                children.append({})
                end.append(-1)
                most.append(0)
            node = children[node][ch]
            most[node] = max(most[node], bound)
        if term.endswith("*"):
            stems.add(node)
        end[node] = t

    def closed(pairs: dict[int, int]) -> frozenset[tuple[int, int]]:
        todo = list(pairs.items())
        while todo:
            node, e = todo.pop()
            if pairs[node] < e:
                continue
            for nxt in children[node].values():
                if e + 1 <= most[nxt] and pairs.get(nxt, 99) > e + 1:
                    pairs[nxt] = e + 1
                    todo.append((nxt, e + 1))
        return frozenset(pairs.items())

    def after(state: frozenset[tuple[int, int]], ch: int) -> frozenset[tuple[int, int]]:
        out = {node: e for node, e in state if node in stems}
        for node, e in state:
            if e + 1 <= most[node] and out.get(node, 99) > e + 1:
                out[node] = e + 1  # ch is one too many
            for own, nxt in children[node].items():
                cost = e + (own != ch)
                if cost <= most[nxt] and out.get(nxt, 99) > cost:
                    out[nxt] = cost
        return closed(out)

    alphabet = sorted({c for kids in children for c in kids})
    number = {frozenset(): 0, (start := closed({0: 0})): 1}
    order, rows = [frozenset(), start], []
    for state in order:
        row = np.zeros(128 + len(extra), np.int32)
        if state:
            for ch in [0, *alphabet]:  # 0 stands for letters of no term
                nxt = after(state, ch)
                if nxt not in number:
                    number[nxt] = len(order)
                    order.append(nxt)
                row[ch if ch else slice(None)] = number[nxt]
        rows.append(row)
    term, distance = np.full(len(order), -1, np.int32), np.zeros(len(order), np.int8)
    for s, state in enumerate(order):
        best = min(((e, end[n]) for n, e in state if end[n] >= 0 and e <= allowed_distance(terms[end[n]])), default=None)
        if best:
            distance[s], term[s] = best
    return Automaton(terms, extra, np.array(rows), term, distance, max((len(t) for t in terms), default=0) + 2 if not stems else 1 << 30)


def letters(data: np.ndarray, extra: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By code point of UTF-8 data: the automaton's letter in lower case, whether it is part of a word, and its first byte."""
    at = np.flatnonzero((data & 0xC0) != 0x80)
    if len(at) == len(data):
        code = data.astype(np.int32)
    else:
        code = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.int32)
        if len(code) != len(at):  # no valid UTF-8
            code = data[at].astype(np.int32)
    upper = (code >= 65) & (code <= 90)
    out, word = np.where(upper, code + 32, code), _LETTERS[np.minimum(code, 127)]
    inner = _INNER[np.minimum(code, 127)] & (code < 128)
    wide = np.flatnonzero(code > 127)
    if len(wide):
        kinds, own = np.unique(code[wide], return_inverse=True)
        low = [ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in map(chr, kinds.tolist())]
        out[wide] = np.array([extra.get(c, c if c < 128 else 0) for c in low], np.int32)[own]
        word[wide] = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in kinds.tolist()], bool)[own]
    if inner.any():
        mid = np.flatnonzero(inner[1:-1] & word[:-2] & word[2:]) + 1
        word[mid] = True
    return out, word, at


def find_terms(data: np.ndarray, automaton: Automaton) -> tuple[np.ndarray, ...]:
    """(start, end, term, distance) of the tokens that the automaton accepts, by start."""
    code, word, byte = letters(data, automaton.extra)
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
    starts, stops = edge[::2], edge[1::2]
    short = stops - starts <= automaton.longest
    starts, stops = starts[short], stops[short]
    state, width = np.ones(len(starts), np.int32), automaton.step.shape[1]
    flat, found, at = automaton.step.reshape(-1), [], starts
    while len(at):
        state = flat[state * width + code[at]]
        at = at + 1
        done = at == stops
        hit = done & (automaton.term[state] >= 0)
        if hit.any():
            found.append(np.stack((starts[hit], stops[hit], automaton.term[state[hit]], automaton.distance[state[hit]])))
        go = ~done & (state > 0)
        starts, stops, state, at = starts[go], stops[go], state[go], at[go]
    both = np.concatenate(found, axis=1) if found else np.zeros((4, 0), np.int64)
    both = both[:, np.argsort(both[0], kind="stable")]
    byte = np.append(byte, len(data))
    return byte[both[0]], byte[both[1]], both[2], both[3]


_PAIRS = {k.encode(): v.encode() for k, v in (("“", "”"), ("«", "»"), ("„", "“"), ("‘", "’"), ("‹", "›"))}
_MARK = re.compile("|".join('"\'“”«»„‘’‹›').encode())
_LETTER = re.compile(rb"[0-9A-Za-z]|[\xc3-\xdf]|\xe2(?![\x80\x81])|[\xe0\xe1\xe3-\xf4]")


def quotations(text: bytes) -> tuple[list[int], list[int]]:
    """Starts and ends of the quotations of a text, of any length and over any lines; one within another is part of it.

    A straight quote opens after white space, a bracket, a colon or a comma. The next one closes it, unless that one opens by the same rule before a letter.
    A single one also needs a letter after it to open and none after it to close, in the same line. “ closes what „ opened, else it opens; ” closes either.
    """
    found, straight, inside = [], {b'"': -1, b"'": -1}, {mark: [] for mark in _PAIRS}
    low, high = "„".encode(), "“".encode()
    for m in _MARK.finditer(text):
        at, mark = m.start(), m.group()
        if mark in straight:
            single, since, letter = mark == b"'", straight[mark], _LETTER.match(text, at + 1)
            opens = text[max(at - 1, 0) : at].strip(b" \t\r\n([{:,") == b"" and (not single or bool(letter))
            if since >= 0 and single and b"\n" in text[since:at]:
                since = -1
            if since >= 0 and not (opens and letter) and not (single and letter):
                found.append((since, at))
                straight[mark] = -1
            elif opens:
                straight[mark] = at
        elif mark == high and inside[low]:
            found.append((inside[low].pop(), at))
        elif mark in _PAIRS:
            inside[mark].append(at)
        else:
            opener = next(o for o, c in _PAIRS.items() if c == mark)
            if opener == high and inside[low] and inside[low][-1] > (inside[high] or [-1])[-1]:
                opener = low
            if inside[opener] and not (mark == "’".encode() and _LETTER.match(text, at + len(mark))):
                found.append((inside[opener].pop(), at))
    starts, ends = [], []
    for a, b in sorted(found):
        if ends and a < ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


#: What is seen around a term, a bit each: it stands in a quotation; a noun that announces it close before; a verb of speech before;
#: someone spoken to around it, outside a quotation; someone spoken to right beside a quotation of a word or two that holds it.
SIGNS = ("quoted", "noun", "speech", "person", "scare")
#: The first three are signs of quotation: a term with none of them is said.
MARKS = 7
#: By number of a context: a constant and its bits.
CONTEXTS = np.hstack((np.ones((1 << len(SIGNS), 1)), (np.arange(1 << len(SIGNS))[:, None] >> np.arange(len(SIGNS))) & 1))


def _words(text: bytes) -> list[str]:
    return re.findall(r"[^\W\d_]+", text.decode("utf-8", "ignore").lower())


def window_context(text: bytes, start: int, end: int, spans: tuple[list[int], list[int]]) -> int:
    """The number of the context of the term at start, by SIGNS."""
    starts, ends = spans
    k = bisect_right(starts, start) - 1
    quoted = k >= 0 and end <= ends[k]
    ahead = lambda at: _words(text[max(0, at - WINDOW) : at].rpartition(b"\n")[2])
    behind = lambda at: _words(text[at : at + WINDOW].partition(b"\n")[0])
    some = lambda words, own: any(w in own for w in words)
    pre, post = ahead(start), behind(end)
    noun = some(pre[-1:], NOUNS) or (len(pre) > 1 and pre[-2] in NOUNS and pre[-1] not in PERSON and len(pre[-1]) < 4)
    noun = noun and not (some(pre[-4:], TURNS) and not quoted)
    told = pre[:-1] if len(pre) > 1 and pre[-1] in ARTICLES and pre[-2] in OTHERS else pre
    speech = some((told[:-1] if told and told[-1] in OTHERS else told)[-1:], SPEECH)
    scare = False
    if quoted and ends[k] - starts[k] <= WINDOW and len(_words(text[starts[k] : ends[k]])) <= SCARE_WORDS:
        scare = some(ahead(starts[k])[-BESIDE:] + behind(ends[k])[:BESIDE], PERSON)
    seen = (quoted, noun, speech, not quoted and some(pre[-BESIDE:] + post[:BESIDE], PERSON), scare)
    return sum(bool(x) << i for i, x in enumerate(seen))


def _pulled(x: np.ndarray, y: np.ndarray, n: np.ndarray, offset: np.ndarray, start: np.ndarray, pull: np.ndarray) -> np.ndarray:
    """Logistic regression of y on x, each row n times and with an offset; the weights are pulled to start."""
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w + offset, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.diag(pull), x.T @ (n * (y - p)) - pull * (w - start))
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return w


@cache
def fit_windows() -> tuple[float, ...]:
    """A constant and the weights of SIGNS from the lines of QUOTING and ABUSING: where labels start from."""
    seen, y = [], []
    for lines, label in ((QUOTING, 1.0), (ABUSING, 0.0)):
        for line in lines:
            at, data = len(line.split("{}")[0].encode()), line.format("term").encode()
            seen.append(window_context(data, at, at + 4, quotations(data)))
            y.append(label)
    size = len(SIGNS) + 1
    return tuple(_pulled(CONTEXTS[seen], np.array(y), np.ones(len(y)), np.zeros(len(y)), np.zeros(size), np.full(size, 0.1)))


#: How many documents the lines above count as, when labels set the weights of SIGNS.
WINDOW_PULL = 2.0


def refit_windows(context: np.ndarray, odds: np.ndarray, clean: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """A constant and the weights of SIGNS, from what labels say of documents with a term in that context.

    odds: the term's log odds of toxicity where it is said; clean: whether these documents are; docs: their number. A sign weighs what it adds to
    a document's odds of being clean, beyond the term's own. Signs that no labelled document shows keep the weights that they start from.
    """
    start = np.array(fit_windows())
    signs = _pulled(CONTEXTS[context, 1:], clean, docs, -odds, start[1:], np.full(len(SIGNS), WINDOW_PULL))
    return np.concatenate((start[:1], signs))


def chances(window: np.ndarray) -> np.ndarray:
    """By context: how likely a term there is quoted or mentioned rather than said."""
    return 1 / (1 + np.exp(-np.clip(CONTEXTS @ window, -30, 30)))


def quotation_chance(text: bytes, start: int, end: int, spans: tuple[list[int], list[int]] | None = None) -> float:
    """How likely the term at start is quoted or mentioned rather than said, before labels are seen. spans: the text's quotations."""
    return float(chances(np.array(fit_windows()))[window_context(text, start, end, quotations(text) if spans is None else spans)])


def is_quoted(text: bytes, start: int, end: int, spans: tuple[list[int], list[int]] | None = None) -> bool:
    return quotation_chance(text, start, end, spans) > 0.5


@dataclass
class ToxicityModel:
    automaton: Automaton
    weights: np.ndarray
    clean_forms: set[str] = field(default_factory=set)
    coef: np.ndarray = field(default_factory=lambda: np.array(PRIOR))
    window: np.ndarray = field(default_factory=lambda: np.array(fit_windows()))


def each_hit(data: np.ndarray, offsets: np.ndarray, automaton: Automaton, clean_forms: set[str] = frozenset()) -> Iterator[tuple[int, str, int, int, int]]:
    """(text, form, term, distance, context) of the hits in texts, misspelt ones of clean_forms left out. Terms do not go over a text's end."""
    gaps = np.insert(data, offsets[1:], 10)  # a line end after each text keeps neighbours apart
    cuts = offsets + np.arange(len(offsets))
    of, text, spans = -1, b"", ([], [])
    for start, end, term, distance in zip(*find_terms(gaps, automaton), strict=True):
        form = gaps[start:end].tobytes().decode("utf-8", "replace").lower()
        if distance and form in clean_forms:
            continue
        k = int(np.searchsorted(cuts, start, side="right")) - 1
        lo = int(cuts[k])
        if k != of:
            of, text = k, gaps[lo : int(cuts[k + 1])].tobytes()
            spans = quotations(text)
        yield k, form, int(term), int(distance), window_context(text, int(start) - lo, int(end) - lo, spans)


def evidence(data: np.ndarray, offsets: np.ndarray, model: ToxicityModel) -> dict[str, np.ndarray]:
    """By text: the strongest hit, the sum of hits, numbers of hits and of quoted ones."""
    n, chance = len(offsets) - 1, chances(model.window)
    out = {"top": np.zeros(n), "total": np.zeros(n), "hits": np.zeros(n, np.int64), "quoted": np.zeros(n, np.int64)}
    for k, _, term, distance, context in each_hit(data, offsets, model.automaton, model.clean_forms):
        weight = model.weights[term] * BY_DISTANCE[distance] * (1.0 - chance[context])
        out["hits"][k] += 1
        out["quoted"][k] += chance[context] > 0.5
        out["total"][k] += weight
        out["top"][k] = max(out["top"][k], weight)
    return out


_KIND = "top double, total double, hits long, quoted long"
_FIELDS = pa.struct([("top", pa.float64()), ("total", pa.float64()), ("hits", pa.int64()), ("quoted", pa.int64())])


def _evidence_column(docs: DataFrame, model: ToxicityModel, text: Column) -> Column:
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a lexicon of bounded size

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [evidence(data, offsets, shared.value) for _, _, data, offsets in text_runs(texts, RUN_BYTES)]
            cols = [pa.array(np.concatenate([p[f.name] for p in parts]) if parts else [], f.type) for f in _FIELDS]
            yield pa.StructArray.from_arrays(cols, fields=list(_FIELDS))

    return F.arrow_udf(run, _KIND)(text)


def _logit(p: float) -> float:
    return math.log(p / (1 - p))


#: A term's documents must be toxic in this share, and of terms with this share of the best gain the most special one is taken.
PRECISION, AS_GOOD = 0.9, 0.98


def _learn_terms(pairs: dict[str, set[int]], toxic: set[int], n: int, support: int, least_gain: float) -> list[str]:
    """Words and stems one by one, each by its likelihood ratio over the documents that earlier ones leave.

    Of those that tell about as much, a word goes before a stem and a longer stem before a shorter one.
    """
    left, bad, chosen = n, set(toxic), []
    gone: set[int] = set()
    while True:
        base, gains = len(bad) / max(left, 1), []
        for word, ids in pairs.items():
            own = ids - gone
            k, m = len(own & bad), len(own)
            if k >= support and k >= PRECISION * m:
                gain = 2 * sum(x * math.log(x / y) for x, y in ((k, m * base), (m - k, m * (1 - base))) if x)
                if gain >= least_gain:
                    gains.append((gain, not word.endswith("*"), len(word), word))
        if not gains:
            return chosen
        best = max(gains)[0]
        word = max(g[1:] for g in gains if g[0] >= AS_GOOD * best)[2]
        chosen.append(word)
        ids = pairs.pop(word) - gone
        gone |= ids
        bad -= ids
        left -= len(ids)


#: Letters of the stems that are tried.
STEMS = (3, 8)


def words_and_stems(text: Column) -> Column:
    """The distinct words of a text, and their beginnings of STEMS letters marked with a star."""
    words = F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), lambda w: F.length(w).between(3, 24))
    begin = lambda w: F.transform(F.sequence(F.lit(STEMS[0]), F.least(F.length(w), F.lit(STEMS[1]))), lambda n: F.concat(F.substring(w, F.lit(1), n), F.lit("*")))
    return F.concat(words, F.array_distinct(F.flatten(F.transform(words, begin))))


def fit_toxicity(
    docs: DataFrame, labels: DataFrame, train_docs: int = 20_000, support: int = 5, least_gain: float = 24.0,
    seeds: tuple[str, ...] = SEED_TERMS, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> ToxicityModel:
    """A model from labelled documents. About train_docs of them, by a hash of the id, are learned from (all, if there are fewer).

    Terms are the seeds and what labels add: words of 3 to 24 letters (so none in scripts that put no spaces between words), and stems for languages that inflect
    them. Each added term needs support toxic documents that no other accounts for, so there are at most train_docs / support. A term's weight is the smoothed log
    odds of documents that say it. Misspelt forms that clean documents use are learned as words of their
    own. What quotation, announcing nouns, verbs of speech and people spoken to say is fitted on the same documents, from weights that hold where
    labels show no such case. Two coefficients and a constant turn the evidence into a probability. Without labels the seeds and default coefficients are used.
    """
    spark = docs.sparkSession
    known = labels.filter(F.col(label_col).isNotNull()).select(F.col(id_col).alias("_id"), (F.col(label_col) > 0).alias("_toxic"))
    share = min(1.0, train_docs / max(known.count(), 1))
    draw = F.pmod(F.xxhash64(F.col("_id").cast("string"), F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.filter(draw < share).groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    picked = saved(docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text")).join(F.broadcast(sample), "_id"))
    words = picked.select("_id", "_toxic", F.explode(words_and_stems(F.coalesce("_text", F.lit("")))).alias("_word"))
    counts = words.groupBy("_word").agg(F.sum(F.col("_toxic").cast("int")).alias("_k"), F.count(F.lit(1)).alias("_m"))
    strong = counts.filter((F.col("_k") >= support) & (F.col("_k") >= PRECISION * F.col("_m")))
    found = words.join(F.broadcast(strong.select("_word")), "_word").select("_word", "_id", "_toxic").toPandas()
    totals = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("_toxic").cast("int")), F.lit(0)).alias("k")).first()
    bad = sample.filter("_toxic").select("_id").toPandas()["_id"]
    pairs = {w: set(g) for w, g in found.groupby("_word")["_id"]} if len(found) else {}
    learned = _learn_terms(pairs, set(bad), totals["n"], support, least_gain)
    terms = sorted({*seeds, *learned})
    model = ToxicityModel(build_automaton(terms), np.full(len(terms), _logit(0.95)))

    shared = spark.sparkContext.broadcast(model)
    schema = "form string, term int, distance int, context int, toxic boolean, id string"
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.string())

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, toxic = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, _, data, offsets in text_runs(batch.column(2), RUN_BYTES):
                rows = list({(*hit, toxic[i + k], ids[i + k]): None for k, *hit in each_hit(data, offsets, shared.value.automaton)})
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=[f.split()[0] for f in schema.split(", ")])

    hits = saved(picked.select(F.col("_id").cast("string"), "_toxic", "_text").mapInArrow(look, schema))
    seen = hits.filter("distance > 0").groupBy("form", "term", "distance").agg(F.countDistinct("id").alias("m"), F.countDistinct(F.when(F.col("toxic"), F.col("id"))).alias("k")).toPandas()
    near = seen.groupby("form")[["k", "m"]].max()
    model.clean_forms = set(near.index[(near["k"] < 0.6 * near["m"])])
    said = hits.filter((F.col("distance") == 0) & (F.col("context").bitwiseAND(MARKS) == 0)).groupBy("term").agg(
        F.countDistinct("id").alias("m"), F.countDistinct(F.when(F.col("toxic"), F.col("id"))).alias("k")
    ).toPandas().set_index("term")
    model.weights = np.array([
        _logit((said["k"].get(t, 0) + 2.85) / (said["m"].get(t, 0) + 3.0)) for t in range(len(terms))
    ]).clip(0, 6)
    around = hits.filter("distance = 0").groupBy("term", "context", "toxic").agg(F.countDistinct("id").alias("n")).toPandas()
    if len(around):
        model.window = refit_windows(
            around["context"].to_numpy(), model.weights[around["term"].to_numpy()], 1.0 - around["toxic"].to_numpy(dtype=float), around["n"].to_numpy(dtype=float)
        )
    rows = picked.select("_toxic", _evidence_column(docs, model, F.col("_text")).alias("e")).select("_toxic", "e.top", "e.total").toPandas()
    if 0 < rows["_toxic"].sum() < len(rows):
        model.coef = _fit_logistic(_inputs(rows["top"].to_numpy(), rows["total"].to_numpy()), rows["_toxic"].to_numpy(dtype=float))
    return model


def _inputs(top: np.ndarray, total: np.ndarray) -> np.ndarray:
    return np.stack((np.ones(len(top)), top, np.log1p(np.maximum(total, 0))), axis=1)


def _fit_logistic(x: np.ndarray, y: np.ndarray, pull: float = 0.1) -> np.ndarray:
    """The coefficients are pulled to those of the default model; evidence never lowers a score."""
    w = _pulled(x, y, np.ones(len(y)), np.zeros(len(y)), np.array(PRIOR), np.array([0.01, pull, pull]))
    w[1:] = np.maximum(w[1:], 0)
    return w


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", name: str = "_toxicity") -> DataFrame:
    """docs with name: struct<score, hits, quoted>. The score rises with unquoted hits and is the base rate without any.

    A null or empty text has no hits. Whole texts of any length are read; copies score alike.
    """
    seen = _evidence_column(docs, model, F.col(text_col).cast("string"))
    coef = [float(c) for c in model.coef]
    with_seen = docs.withColumn(name, seen)
    x = F.col(name)
    line = F.lit(coef[0]) + coef[1] * x["top"] + coef[2] * F.log1p(F.greatest(x["total"], F.lit(0.0)))
    return with_seen.withColumn(name, F.struct((1 / (1 + F.exp(-line))).alias("score"), x["hits"].alias("hits"), x["quoted"].alias("quoted")))


def op3_model(spark, sf_dir: str, docs: DataFrame) -> ToxicityModel:
    return fit_toxicity(docs, table(spark, sf_dir, "labels").filter(crc_mod("doc_id", 3) != 1))


THRESHOLD = 0.7


def op3_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    got = score_toxicity(docs.select("doc_id", "text"), op3_model(spark, sf_dir, docs))
    score = F.col("_toxicity.score")
    return got.select(
        "doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"),
        F.col("_toxicity.hits").alias("n_hits"), F.col("_toxicity.quoted").alias("n_quoted"),
    )
