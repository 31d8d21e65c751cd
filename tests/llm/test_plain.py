"""Plain versions, row by row and without numpy: the scores of both classifiers, and all stages of the pipeline."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from fieldpulse.llm import quality, toxicity
from fieldpulse.llm.learning import fold
from fieldpulse.llm.words import slices

SF = "/root/testdata/sf0.001"
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
TOKEN = re.compile(rb"[^\x20\x09-\x0d]+")
MASK = (1 << 64) - 1
BASE = 0x9E3779B97F4A7C15


def lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def spread(value):
    value = (value ^ (value >> 30)) * 0xBF58476D1CE4E5B9 & MASK
    value = (value ^ (value >> 27)) * 0x94D049BB133111EB & MASK
    return value ^ (value >> 31)


def hashed(word):
    return sum((byte + 1) * pow(BASE, place, 1 << 64) for place, byte in enumerate(word)) & MASK


def sigmoid(value):
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def plain_toxicity(text, fitted, machine):
    found = set()
    for word in WORD.findall(lower(text)):
        found.add(spread(hashed(word)) >> (64 - machine.bits))
        for length in machine.prefixes:
            if len(word) > length:
                value = spread((hashed(word[:length]) + length) & MASK)
                found |= {value >> (64 - machine.bits)} if value else set()
    held = [index for index, term in enumerate(fitted.terms.tolist()) if term in found]
    total = fitted.bias + sum(float(fitted.weights[i]) for i in held)
    # The pairs themselves, not the difference of squares.
    total += sum(float(a) * float(b) for n, i in enumerate(held) for j in held[n + 1:] for a, b in zip(fitted.factors[i], fitted.factors[j]))
    return sigmoid(total)


TEXTS = [None, "", " ", "ÀÉ x", "plain words of a text, and more of them.", "Shout! SHOUT! shout! # $ 12 34\n\nend", "w " * 3000, "é" * 5000 + " 1.2.3"]


def test_toxicity_scores_match_a_plain_version(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    machine = toxicity.Machine()
    fitted = toxicity.fit(docs, labels, fold(F.col("doc_id"), 5) != 0, machine=machine)
    rows = [(row.doc_id, row.text) for row in docs.where("length(text) < 4000").collect()] + [(-i - 1, text) for i, text in enumerate(TEXTS)] + [(-1, None)]
    got = toxicity.score(spark.createDataFrame([(*row, "clash") for row in rows], "doc_id long, text string, score string"), fitted).collect()
    assert len(got) == len(rows)
    want = {doc: plain_toxicity(text, fitted, machine) for doc, text in rows}
    assert all(abs(row.score - want[row.doc_id]) < 1e-5 for row in got)


def test_machine_learns_what_weights_cannot(spark):
    """Toxic if exactly one of two words is there: no sum of weights can say that, a product can."""
    draw, rows = np.random.default_rng(5), []
    for doc in range(1200):
        one, two = draw.integers(0, 2, 2)
        rows.append((doc, " ".join(["alphaword"] * int(one) + ["betaword"] * int(two) + [f"filler{n}" for n in draw.integers(0, 12, 5)]), int(one != two)))
    docs = spark.createDataFrame([row[:2] for row in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(row[0], row[2]) for row in rows], "doc_id long, toxic int")
    right = {}
    for factors in (6, 0):
        machine = toxicity.Machine(factors=factors, epochs=60, prefixes=())
        fitted = toxicity.fit(docs, labels, F.col("doc_id") % 4 != 0, machine=machine)
        part = next(slices(pa.array([row[1] for row in rows if row[0] % 4 == 0])))
        margin = toxicity.margins(part, fitted, machine)
        right[factors] = np.mean((margin > 0) == np.array([row[2] for row in rows if row[0] % 4 == 0], bool))
    assert right[6] > 0.97 and right[0] < 0.8


def plain_measures(text):
    data = (text or "").encode()
    tokens, size = TOKEN.findall(lower(text)), max(1, len(data))
    some = max(1, len(tokens))
    pairs = list(zip(tokens, tokens[1:]))
    capitals, small = sum(65 <= b <= 90 for b in data), sum(97 <= b <= 122 for b in data)
    marks = set(b"#$%&*|<>{}[]=~^_\\/@+")
    return [math.log1p(len(tokens)), len(set(tokens)) / some ** 0.85, sum(a == b for a, b in pairs) / some, len(set(pairs)) / some,
            capitals / max(1, capitals + small), sum(b in marks for b in data) / size, sum(b in b".,;:!?" for b in data) / size, sum(48 <= b <= 57 for b in data) / size,
            sum(map(len, tokens)) / some, data.count(b"\n") / some, sum(any(b in marks for b in token) for token in tokens) / some, data.count(b"!") / some]


def plain_quality(text, fitted):
    total, place = float(fitted.weights[0]), 1
    for value, cuts in zip(plain_measures(text), fitted.edges.tolist()):
        # Cuts are values of documents, so powers and logarithms that differ in the last bit must not fall on the other side.
        total += float(fitted.weights[place + sum(cut <= value + 1e-12 * (1 + abs(value)) for cut in cuts)])
        place += len(cuts) + 1
    return sigmoid(total)


def quality_of(spark, docs):
    return quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"), fold(F.col("doc_id"), 3) != 1)


def test_quality_scores_match_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fitted = quality_of(spark, docs)
    rows = [(row.doc_id, row.text) for row in docs.collect()] + [(-i - 1, text) for i, text in enumerate(TEXTS)] + [(-1, None)]
    got = quality.score(spark.createDataFrame(rows, "doc_id long, text string"), fitted).collect()
    want = {doc: plain_quality(text, fitted) for doc, text in rows}
    assert len(got) == len(rows) and all(abs(row.score - want[row.doc_id]) < 1e-6 for row in got)


# -- the pipeline, each stage on plain rows (doc_id, text, source) ------------------------------------

def plain_lines(rows):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    held = defaultdict(set)
    for doc, text, _ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                held[key(line)].add(doc)
    last = {line: max(docs) for line, docs in held.items() if len(docs) >= 5}
    out = []
    for doc, text, source in rows:
        lines = (text or "").split("\n")
        stay = [line for line in lines if last.get(key(line), doc) == doc]
        if len(stay) == len(lines):
            out.append((doc, text, source))
        elif "\n".join(stay):
            out.append((doc, "\n".join(stay), source))
    return out


def plain_near(rows):
    sets = []
    for _, text, _ in rows:
        words = WORD.findall(lower(text))
        sets.append({tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and min(len(a), len(b)) >= 0.8 * max(len(a), len(b)) and len(a & b) / len(a | b) >= 0.8:
                group[root(i)] = root(j)
    best = {}
    for i, (doc, text, _) in enumerate(rows):
        if sets[i]:
            place = (doc, hashlib.sha256(text.encode()).digest(), i)
            best[root(i)] = min(best.get(root(i), place), place)
    return [row for i, row in enumerate(rows) if not sets[i] or best[root(i)][2] == i]


def plain_cut(rows, items):
    spell = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    low = lambda text: text.translate({c: c + 32 for c in range(65, 91)})
    windows = set()
    for text in items:
        words = spell.findall(low(text or ""))
        windows |= {tuple(words[i:i + 10]) for i in range(max(1, len(words) - 9))} if words else set()
    sizes, out = {len(window) for window in windows}, []
    for doc, text, source in rows:
        found = list(spell.finditer(text or ""))
        words, hit = [low(m.group()) for m in found], set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in windows:
                    hit.update(range(i, i + size))
        if hit:
            cuts = [(found[a].start(), found[b].end()) for a, b in
                    [(i, max(j for j in range(i, len(words)) if set(range(i, j + 1)) <= hit)) for i in sorted(hit) if i - 1 not in hit]]
            begin, kept = 0, ""
            for a, b in cuts:
                kept, begin = kept + text[begin:a], b
            text = kept + text[begin:]
            if not spell.search(text):
                continue
        out.append((doc, text, source))
    return out


def plain_mix(rows):
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", text or "")) for i, (_, text, _) in enumerate(rows)}
    members = defaultdict(list)
    for i, (_, _, source) in enumerate(rows):
        members[source].append(i)
    names = sorted(members, key=lambda name: (name is None, name or ""))
    weight = {name: (5, 2, 1)[n % 3] for n, name in enumerate(names)}
    total = {name: sum(size[i] for i in members[name]) for name in names}
    # Water filling: whoever is above the bound gets it, the others share what is left.
    bound, left = set(), sum(total.values())
    while True:
        free = [name for name in names if name not in bound]
        level = (left - sum(3 * total[name] for name in bound)) / sum(weight[name] for name in free)
        over = [name for name in free if level * weight[name] > 3 * total[name]]
        if not over:
            break
        bound |= set(over)
    copies = {}
    for name in names:
        target = 3.0 * total[name] if name in bound else level * weight[name]
        whole = math.floor(target / total[name]) if total[name] else 0
        rest = target - whole * total[name]
        falling = sorted({size[i] for i in members[name] if size[i]}, reverse=True)
        certain, c = None, 0.0
        for s in falling:
            larger, squares = sum(size[i] for i in members[name] if size[i] > s), sum(size[i] ** 2 for i in members[name] if size[i] <= s)
            if (rest - larger) / squares * s < 1:
                certain, c = s, (rest - larger) / squares
                break
        odds = {}
        for i in members[name]:
            doc, text, _ = rows[i]
            digits = hashlib.md5(f"mix:{doc}:{hashlib.md5((text or '').encode()).hexdigest()}".encode()).hexdigest()[:13]
            u, p = (int(digits, 16) + 0.5) / (1 << 52), (1.0 if certain is not None and size[i] > certain else c * size[i]) if rest > 0 else 0.0
            if p > 0:
                odds[i] = 0.0 if p >= 1 else (u / (1 - u)) / (p / (1 - p))
        taken, words = set(), 0
        for i in sorted(odds, key=lambda i: (odds[i], str(rows[i][0]), size[i])):
            upto = words + size[i]
            if upto <= rest or (words <= rest and upto - rest < rest - words):
                taken.add(i)
            words = upto
        gap = rest - sum(size[i] for i in taken)
        off = [(abs(gap - (-size[i] if i in taken else size[i])), i in taken, odds.get(i, math.inf), str(rows[i][0]), size[i], i) for i in members[name] if size[i] and rest > 0]
        off = [entry for entry in off if entry[0] < abs(gap)]
        if off:
            taken ^= {min(off)[-1]}
        copies |= {i: whole + (i in taken) for i in members[name]}
    return copies


def test_pipeline_matches_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fitted = quality_of(spark, docs)
    rows = [(row.doc_id, row.text, row.source) for row in docs.collect()]
    items = [row.text for row in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = [row for row in rows if plain_quality(row[1], fitted) >= 0.5]
    assert 0 < len(kept) < len(rows)
    near = plain_near(plain_lines(kept))
    assert len(near) < len(kept)
    clean = plain_cut(near, items)
    copies = plain_mix(clean)
    want = Counter((clean[i][0], clean[i][1], n) for i, n in copies.items() if n)
    got = Counter((row.doc_id, row.text, row.copies) for row in corpus_pipeline.run(spark, SF).collect())
    assert {row[:2] for row in got} - {row[:2] for row in clean} == set()
    assert got == want
