"""Personal data by a semi-Markov conditional random field over whole spans.

Stretches of a text that hold digits with their separators, or a mail sign with what stands around it,
are split into units: runs of digits, runs of letters, single other characters. A segmentation of a
stretch is a row of segments, each one unit outside of any entity or an entity of several units with a
type. Its score is the sum of weights of features of whole segments (groups of digits and their lengths,
separators, check digit, ranges, what stands before and after, and so on) and of neighbouring types. The
best segmentation is found by dynamic programming over units with entities of at most MOST_UNITS units, so
boundaries and types are decided together: two numbers with one space between them come apart, although
the plain pattern takes them as one and drops it.

The weights maximise the regularised log-likelihood of stretches sampled from the corpus. Labels are the
matches of the plain patterns, where these are beyond doubt, and rewritten forms of them that the
patterns miss (other separators, a number without its plus sign, a spelt-out mail sign, two entities
side by side).

Matches of the plain patterns always stay: they are candidate segments whatever their length, with a
bonus that no other score outweighs, and those that overlap each other are all kept.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections import Counter
from functools import lru_cache
from itertools import accumulate, pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from proofline.llm import text as tx

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 20_000
SAMPLE_STRETCHES = 600
MOST_UNITS = 16
MOST_CHARS = 64
CONTEXT = 12
TRAIN_UNITS = 30
STEPS = 50
PENALTY = 0.5
CUE_LEAST = 5
BONUS = 1e6

# fixed values: the plain patterns
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

UNIT = re.compile(r"[0-9]+|[A-Za-z]+|[^A-Za-z0-9]", re.DOTALL)
NUMBERS = re.compile(r"[+(]{0,2}[0-9]++(?:[ ().+-]{1,3}[0-9]++)*+")
SIGN = re.compile(r"@|[(\[]at[)\]]")
SPELT = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?[(\[]dot[)\]] ?)[A-Za-z0-9-]+)+")
SPELT_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LAST_WORD = re.compile(r"([A-Za-z]+)[^A-Za-z0-9]{0,3}\Z")
DIGIT_OR_SIGN = re.compile(r"[0-9@\[(]")


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def small(part: str) -> bool:
    """A part of an address that is at most 255; any number of zeros may stand before it."""
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def only_digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def plain_matches(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """(start, kind, end) of the matches of the plain patterns in order, and (start, end) of doubtful dropped ones.

    A dropped match is doubtful if it has too many digits: it may hold several entities.
    """
    found, doubtful = [], []
    at, begin = text.find("@"), 0
    while at >= 0:
        first = at
        while first > begin and text[first - 1] in LOCAL_CHARS:
            first -= 1
        match = DOMAIN.match(text, at + 1) if first < at else None
        if match:
            found.append((first, 0, match.end()))
            begin = match.end()
        else:
            begin = at + 1  # the sign itself is in no local part
        at = text.find("@", begin)
    for match in IP.finditer(text):
        if all(map(small, match.group().split("."))):
            found.append((match.start(), 1, match.end()))
    for match in CARD.finditer(text):
        digits = only_digits(match.group())
        if 12 <= len(digits) <= 19:
            if luhn(digits):
                found.append((match.start(), 2, match.end()))
        elif len(digits) > 19:
            doubtful.append(match.span())
    for match in PHONE.finditer(text):
        digits = only_digits(match.group())
        if 9 <= len(digits) <= 15:
            found.append((match.start(), 3, match.end()))
        elif len(digits) > 15:
            doubtful.append(match.span())
    return sorted(found), doubtful


def stretches(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Where entities can stand, in order; no two touch. Every plain match lies in one of them."""
    found = [(a, z) for a, _, z in base]
    for match in NUMBERS.finditer(text):
        if match.end() - match.start() >= 7 and sum(map(str.isdigit, match.group())) >= 7:
            found.append(match.span())
    for sign in SIGN.finditer(text):
        a, z = sign.start() - (text[sign.start() - 1 : sign.start()] == " "), sign.end() + (text[sign.end() : sign.end() + 1] == " ")
        left = SPELT_LOCAL.search(text, max(0, a - MOST_CHARS), a)
        right = SPELT.match(text, z, z + MOST_CHARS) if left else None
        if right:
            found.append((left.start(), right.end()))
    out: list[tuple[int, int]] = []
    for a, z in sorted(found):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(z, out[-1][1])
        else:
            out.append((a, z))
    return out


@lru_cache(maxsize=50_000)
def _shape(kind: int, shape: str) -> tuple[str, ...]:
    """Features of a span's shape: digits are 9, letters a, the rest as it is."""
    groups = re.findall("9+", shape)
    digits = sum(map(len, groups))
    out = ["bias", f"digits={min(digits, 24)}", f"groups={min(len(groups), 8)}", f"separators={''.join(sorted(set(shape) - {'9', 'a'}))}"]
    if kind:
        out += [f"lengths={'-'.join(str(min(len(g), 20)) for g in groups[:8])}", f"first={min(len(groups[0]), 20)}", f"last={min(len(groups[-1]), 20)}", f"starts={shape[0]}"]
    else:
        host = shape[max(shape.rfind("@"), shape.rfind("at")) + 1 :]
        out += [f"plain_sign={'@' in shape}", f"dots={min(host.count('.'), 4)}", f"ends={shape[-1]}", f"starts={shape[0]}", f"spaces={min(shape.count(' '), 4)}"]
    return tuple(out)


def features(kind: int, text: str, a: int, z: int) -> list[str]:
    """Features of a whole span of the text as a kind."""
    span = text[a:z]
    shape = re.sub("[0-9]", "9", re.sub("[A-Za-z]+", lambda m: m.group() if m.group() in ("at", "dot") else "a", span))
    out = list(_shape(kind, shape))
    before, after = text[a - 1 : a], text[z : z + 1]
    for side, c in (("before", before), ("after", after)):
        out.append(f"{side}={'edge' if not c else 'word' if c.isalnum() else 'space' if c.isspace() else 'point' if c in '.,;:!?' else 'other'}")
    if kind == 1:
        out.append(f"ranges={all(map(small, re.split('[^0-9]+', span)))}")
    if kind in (2, 3):
        digits = only_digits(span)
        out.append(f"check={len(digits) >= 12 and luhn(digits)}")
        if kind == 2:
            out.append(f"check,digits={luhn(digits)},{len(digits)}")
    cue = LAST_WORD.search(text, max(0, a - CONTEXT), a)
    if cue:
        out.append(f"cue={cue.group(1).lower()}")
    return [f"{KINDS[kind]}:{f}" for f in out]


def outside(unit: str) -> list[str]:
    """Features of a unit outside of entities."""
    kind = "digits" if unit[0] in "0123456789" else "letters" if unit.isascii() and unit.isalpha() else unit
    return [f"out:{kind}", f"out:digits={min(len(unit), 20)}"] if kind == "digits" else [f"out:{kind}"]


def mail_candidates(text: str, cuts: list[int], first: list[str], word: list[bool]) -> dict[int, list[tuple[int, int]]]:
    """(end unit, kind) of possible mail addresses by first unit, around every mail sign."""
    n, out = len(first), {}
    for s in range(1, n - 1):
        spelt = word[s] and text[cuts[s] : cuts[s + 1]] == "at" and first[s - 1] in "([" and first[s + 1] in ")]"
        if not spelt and first[s] != "@":
            continue
        low, high = s - 1 - spelt, s + 1 + spelt
        low, high = low - (low >= 0 and first[low] == " "), high + (high < n and first[high] == " ")
        i = low
        while i >= 0 and s - i < MOST_UNITS and (word[i] or first[i] in "._%+-"):
            for j in range(high, min(n, i + MOST_UNITS) if word[i] else 0):
                if not (word[j] or first[j] in ".-()[] "):
                    break
                if word[j] and cuts[j + 1] - cuts[i] <= MOST_CHARS and SPELT.fullmatch(text, cuts[high], cuts[j + 1]):
                    out.setdefault(i, []).append((j + 1, 0))
            i -= 1
    return out


def segments(text: str, cuts: list[int], base: list[tuple[int, int, int]]):
    """(first unit, end unit, kind) of all segments of a stretch with these unit boundaries, by first unit.

    kind is -1 outside of entities. Entities have bounds in units and characters, but for the plain matches.
    """
    n = len(cuts) - 1
    first = [text[c] for c in cuts[:-1]]
    digit = [c in "0123456789" for c in first]
    word = [d or (c.isascii() and c.isalpha()) for c, d in zip(first, digit, strict=True)]
    mails = mail_candidates(text, cuts, first, word)
    at = {c: k for k, c in enumerate(cuts)} if base else {}
    sure: dict[int, list[tuple[int, int]]] = {}
    for s, kind, e in base:
        sure.setdefault(at[s], []).append((at[e], kind))
    for i in range(n):
        found = {*mails.get(i, ()), *sure.get(i, ())}
        if digit[i] or (first[i] in "+(" and i + 1 < n and (digit[i + 1] or first[i + 1] == "(")):
            count = groups = 0
            for j in range(i, min(n, i + MOST_UNITS)):
                if digit[j]:
                    count, groups = count + cuts[j + 1] - cuts[j], groups + 1
                elif first[j] not in " ().+-":
                    break
                if count > 19 or cuts[j + 1] - cuts[i] > MOST_CHARS:
                    break
                if digit[j]:
                    if j == i + 6 and digit[i] and first[i + 1 : j : 2] == [".", ".", "."]:
                        found.add((j + 1, 1))
                    if count >= 12:
                        found.add((j + 1, 2))
                    if 9 <= count <= 15 and (groups > 1 or first[i] == "+"):
                        found.add((j + 1, 3))
        yield i, i + 1, -1
        for j, kind in sorted(found):
            yield i, j, kind


def units(text: str, a: int, z: int) -> list[int]:
    """The boundaries of the units of a stretch."""
    return [m.start() for m in UNIT.finditer(text, a, z)] + [z]


def best_segments(text: str, cuts: list[int], base: list[tuple[int, int, int]], weights: dict[str, float], moves: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the entities of the best segmentation; of equal ones the first found stays."""
    sure = {(s, e, kind) for s, kind, e in base}
    n, kinds, low = len(cuts) - 1, len(KINDS) + 1, float("-inf")
    open_: dict[int, list[float]] = {0: [*[low] * len(KINDS), 0.0]}  # best scores by type up to the units ahead
    back: list[list[tuple[int, int] | None]] = [[None] * kinds for _ in range(n + 1)]
    steps, here = moves.tolist(), -1
    for i, j, kind in segments(text, cuts, base):
        if i != here:
            here, best = i, open_.pop(i)
            into = [max((best[b] + steps[b][k], -b) for b in range(kinds)) for k in range(kinds)]
        names = outside(text[cuts[i] : cuts[j]]) if kind < 0 else features(kind, text, cuts[i], cuts[j])
        score, before = into[kind][0] + sum(weights.get(f, 0.0) for f in names), -into[kind][1]
        if kind >= 0 and (cuts[i], cuts[j], kind) in sure:
            score += BONUS
        ahead = open_.setdefault(j, [low] * kinds)
        if score > ahead[kind]:
            ahead[kind] = score
            back[j][kind] = i, before
    last = open_[n]
    at, kind = n, max(range(kinds), key=last.__getitem__)
    out = []
    while at > 0:
        first, before = back[at][kind]
        if kind < len(KINDS):
            out.append((cuts[first], kind, cuts[at]))
        at, kind = first, before
    return out[::-1]


def find_spans(text: str, model: dict | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(start, kind, end) of the plain matches, and of all spans of the text, in order."""
    if not DIGIT_OR_SIGN.search(text):
        return [], []
    base, _ = plain_matches(text)
    if model is None:
        return base, base
    found, k = set(base), 0
    for a, z in stretches(text, base):
        begin = k
        while k < len(base) and base[k][0] < z:
            k += 1
        inside = base[begin:k]
        starts, reach = [s for s, _, _ in inside], list(accumulate((e for _, _, e in inside), max))
        for s, kind, e in best_segments(text, units(text, a, z), inside, model["weights"], model["moves"]):
            before = bisect_left(starts, e)
            if not before or reach[before - 1] <= s:  # it overlaps no plain match
                found.add((s, kind, e))
    return base, sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{a}:{z}" for a, kind, z in spans)


# ---- learning


def variants(text: str, a: int, kind: int, z: int) -> list[str]:
    """Other ways to write a plain match."""
    span = text[a:z]
    if kind == 0:
        name, host = span.rsplit("@", 1)
        return [f"{name}{sign}{host.replace('.', dot)}" for sign, dot in ((" (at) ", " (dot) "), ("[at]", "."), (" [at] ", "[dot]"))]
    if kind == 2:
        digits = only_digits(span)
        fours = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        return [".".join(fours), " ".join(fours), digits]
    if kind == 3:
        parts = re.findall("[0-9]+", span)
        if len(parts) < 3:
            return []
        local = [f"({parts[1]}) {'-'.join(parts[2:])}", "-".join(parts[1:]), ".".join(parts[1:])] if len("".join(parts[1:])) >= 9 else []
        return [*local, "+" + ".".join(parts), "00" + " ".join(parts), "+" + "-".join(parts)]
    return []


def examples(pieces: list[str]) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Texts with their spans, from pieces of text around stretches; those with doubtful matches are left out."""
    out, singles = [], []
    for piece in pieces:
        base, doubtful = plain_matches(piece)
        if doubtful or any(x[2] > y[0] for x, y in pairwise(base)):
            continue
        out.append((piece, base))
        for a, kind, z in base[:1]:
            left, right = piece[:a], piece[z:]
            singles.append((piece[a:z], kind))
            for other in variants(piece, a, kind, z):
                if len(base) == 1:
                    out.append((left + other + right, [(a, kind, a + len(other))]))
    for (one, x), (two, y) in zip(singles[::2], singles[1::2], strict=False):
        out.append((f"{one} {two}", [(0, x, len(one)), (len(one) + 1, y, len(one) + 1 + len(two))]))
    return out


def train(texts: list[tuple[str, list[tuple[int, int, int]]]]) -> dict | None:
    """Weights by maximum likelihood: forward and backward sums over all segmentations, for all stretches at once."""
    rows = []
    for text, spans in texts:
        for a, z in stretches(text, spans):
            inside = [s for s in spans if a <= s[0] and s[2] <= z]
            cuts = units(text, a, z)
            if len(cuts) - 1 <= TRAIN_UNITS:
                found = [(i, j, k, outside(text[cuts[i] : cuts[j]]) if k < 0 else features(k, text, cuts[i], cuts[j])) for i, j, k in segments(text, cuts, inside)]
                rows.append((cuts, found, {cuts.index(s): (cuts.index(e), kind) for s, kind, e in inside}))
    if not rows:
        return None
    cues = Counter(f for _, found, _ in rows for f in {f for s in found for f in s[3] if ":cue=" in f})
    kinds, longest = len(KINDS) + 1, max(len(cuts) - 1 for cuts, _, _ in rows)
    names: dict[str, int] = {}
    cell, gold, index, owner = [], [], [], []
    steps_seen = np.zeros((kinds, kinds))
    for r, (cuts, found, true) in enumerate(rows):
        n, at, before, path = len(cuts) - 1, 0, kinds - 1, set()
        while at < n:
            j, kind = true.get(at, (at + 1, kinds - 1))
            path.add((at, j, kind))
            steps_seen[before, kind] += 1
            at, before = j, kind
        for i, j, kind, own in found:
            # units end at the last place, so stretches of all lengths finish together
            cell.append((r, j + longest - n, j - i, kind % kinds))
            gold.append((i, j, kind % kinds) in path)
            known = [f for f in own if cues.get(f, CUE_LEAST) >= CUE_LEAST]
            index += [names.setdefault(f, len(names)) for f in known]
            owner += [len(cell) - 1] * len(known)
    cells = np.array(cell)
    gold, index, owner = np.array(gold), np.array(index), np.array(owner)
    start = np.array([longest - len(cuts) + 1 for cuts, _, _ in rows])
    seen = np.bincount(index[gold[owner]], minlength=len(names)).astype(float)
    weights, moves = np.zeros(len(names)), np.zeros((kinds, kinds))
    rate = [[np.zeros_like(x), np.zeros_like(x)] for x in (weights, moves)]
    for step in range(1, STEPS + 1):
        score = np.bincount(owner, weights[index], len(cell))
        expect, moved = _expected(score, cells, start, longest, moves)
        up = seen - np.bincount(index, expect[owner], len(names)) - PENALTY * weights, steps_seen - moved - PENALTY * moves
        for x, g, (mean, square) in zip((weights, moves), up, rate, strict=True):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            x += 0.3 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return {"weights": {n: float(weights[k]) for n, k in names.items()}, "moves": moves}


def _log_product(x: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The logarithm of exp(x) @ m, row by row."""
    top = x.max(1, keepdims=True)
    top = np.where(np.isfinite(top), top, 0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(x - top) @ m) + top


def _expected(score, cells, start, longest, moves) -> tuple[np.ndarray, np.ndarray]:
    """Expected number of each segment, and of each pair of neighbouring types, under the model.

    cells (row, end, units, type) of the segments; every row begins at its start and ends at `longest`.
    """
    kinds, n, step = len(moves), len(start), np.exp(moves)
    r, e, d, k = cells.T
    s = e - d
    by_end, by_start = ([np.flatnonzero(x == at) for at in range(longest + 1)] for x in (e, s))
    forward = np.full((n, longest + 1, kinds), -np.inf)
    forward[np.arange(n), start, kinds - 1] = 0
    into, leave, backward = (np.full((n, longest + 1, kinds), -np.inf) for _ in range(3))
    backward[:, longest] = 0
    for at in range(longest + 1):
        own = by_end[at]
        np.logaddexp.at(forward, (r[own], e[own], k[own]), into[r[own], s[own], k[own]] + score[own])
        # by the type of the segment that begins here
        into[:, at] = _log_product(forward[:, at], step)
    for at in range(longest - 1, -1, -1):
        own = by_start[at]
        np.logaddexp.at(leave, (r[own], s[own], k[own]), backward[r[own], e[own], k[own]] + score[own])
        # by the type of the segment that ends here
        backward[:, at] = _log_product(leave[:, at], step.T)
    whole = _log_product(forward[:, longest], np.ones((kinds, 1)))[:, 0]
    rest = score + backward[r, e, k] - whole[r]
    expect = np.exp(into[r, s, k] + rest)
    moved = np.stack([np.bincount(k, np.exp(forward[r, s, b] + moves[b, k] + rest), kinds) for b in range(kinds)])
    return expect, moved


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, most: int = SAMPLE_STRETCHES) -> dict | None:
    """Learn from at most `most` stretches of about `rows` rows of docs (doc_id, text), both chosen by hashes.

    Each stretch comes with CONTEXT characters on both sides. None if there is none. Null and empty texts
    hold none; other columns are not read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    total = docs.count()
    share = min(1.0, rows / max(1, total))
    chosen = docs.where(F.pmod(F.xxhash64("doc_id", "text", F.lit(11)), F.lit(1_000_000)) < share * 1_000_000)

    def run(batches):
        for batch in batches:
            found = []
            for a, z in tx.slices(batch):
                for text in batch.column("text")[a:z].to_pylist():
                    if DIGIT_OR_SIGN.search(text):
                        found += [text[max(0, p - CONTEXT) : q + CONTEXT] for p, q in stretches(text, plain_matches(text)[0]) if q - p <= 4 * MOST_CHARS]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["piece"])

    pieces = chosen.select("text").mapInArrow(run, "piece string").distinct()
    picked = pieces.orderBy(F.xxhash64("piece"), "piece").limit(most).collect()
    model = train(examples(sorted(r["piece"] for r in picked)))
    if model:
        model["name"] = hashlib.sha256(repr(sorted(model["weights"].items())).encode()).hexdigest()
    return model


# ---- on tables


def _found(docs: DataFrame, model: dict | None) -> DataFrame:
    """docs (doc_id, text) with the plain matches and all spans."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        for batch in batches:
            for a, z in tx.slices(batch):
                part = batch.slice(a, z - a)
                counts, digests, all_ = np.zeros((z - a, len(KINDS)), np.int64), [], []
                for k, text in enumerate(part.column("text").to_pylist()):
                    base, spans = find_spans(text or "", own)
                    for _, kind, _ in base:
                        counts[k, kind] += 1
                    digests.append(hashlib.sha256(written(base).encode()).hexdigest())
                    all_.append(written(spans))
                names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(c) for c in counts.T.copy()), pa.array(digests, pa.string()), pa.array(all_, pa.string())], names)

    schema = ", ".join(["doc_id long", *(f"n_{k} long" for k in KINDS), "base_sha256 string", "spans string"])
    return docs.mapInArrow(run, schema)


def find_pii(docs: DataFrame, model: dict | None) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of docs (doc_id, text), over the whole text.

    The counts and the digest are of the plain matches; spans are all spans as kind:start:end in code points,
    end exclusive, by start, then kind. Null and empty texts hold nothing. Rows with a null doc_id and
    repeated rows stay; other columns are not read; without a model there are the plain matches only. Very
    long texts are cut into stretches, so the work grows with their length.
    """
    return _found(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), model)


def without_pii(docs: DataFrame, model: dict | None) -> DataFrame:
    """docs with every span of the texts replaced by its kind in brackets; all columns and rows stay, as do nulls."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def clean(text: str | None) -> str | None:
        if text is None:
            return None
        out, at = [], 0
        for a, kind, z in find_spans(text, shared.value)[1]:
            if a >= at:
                out += [text[at:a], f"[{KINDS[kind]}]"]
            at = max(at, z)
        return "".join([*out, text[at:]])

    def run(batches):
        for batch in batches:
            k = batch.schema.get_field_index("text")
            for a, z in tx.slices(batch):
                part = batch.slice(a, z - a)
                yield part.set_column(k, batch.schema.field(k), pa.array([clean(t) for t in part.column("text").to_pylist()], batch.schema.field(k).type))

    return docs.mapInArrow(run, docs.schema)
