"""Secret scans: fixed patterns, and a character convolutional network over all other candidates.

Every token of 6 or more characters that are no spaces is a candidate, or what patterns leave of it where that has 6.
The network sees it with its surroundings and was trained, in numpy, on labelled findings that a seeded rule writes; its output is calibrated on findings
kept back, and the threshold is the highest that finds the wanted share of their secrets.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ratelens.llm.common import with_ids_as_text

# The patterns of the contract. Letters of "assign" count in either case, in ASCII only.
KINDS = {
    "assign": (re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20),
    "hex": (re.compile(r"[0-9a-f]{24,}"), 0, 24),
}
ORDER = {kind: k for k, kind in enumerate([*KINDS, "cnn"])}
CANDIDATE = re.compile(r"[^\x20\x09-\x0D]{6,}")
LEAST, CONTEXT, FILTERS, WIDTH, CLASSES = 6, 16, 16, 5, 72
#: Characters of a text whose convolution is held at once; a longer candidate is held whole.
STRETCH = 1 << 14
RECALL = 0.95


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the patterns' findings, leftmost and not overlapping within a kind."""
    out = []
    for kind, (pattern, group, least) in KINDS.items():
        if kind == "assign" and "=" not in text and ":" not in text or kind == "access" and "AKIA" not in text:
            continue
        for found in pattern.finditer(text):
            if len(found[group]) >= least:
                out.append((found.start(), kind, found.end()))
    return sorted(out, key=lambda s: (s[0], ORDER[s[1]]))


def candidates(text: str, taken: list[tuple[int, str, int]]) -> list[tuple[int, int]]:
    """Spans of all tokens of LEAST or more characters, less the patterns' findings."""
    out, at, taken = [], 0, sorted((s, e) for s, _, e in taken)
    for found in CANDIDATE.finditer(text):
        start, end = found.span()
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        for s, e in taken[at:]:
            if s >= end:
                break
            if s - start >= LEAST:
                out.append((start, s))
            start = max(start, e)
        if end - start >= LEAST:
            out.append((start, end))
    return out


def codes(text: str) -> np.ndarray:
    """Character classes: letters and digits by themselves, some signs, spaces, and all the rest."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return TABLE[np.minimum(points, 128)]


# Classes of characters; 0 is padding, 1 any other.
LOOKUP = {c: k + 2 for k, c in enumerate("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/=_.-")} | {" ": 70, "\n": 70, "\"": 71, "'": 71, ":": 71}


TABLE = np.array([LOOKUP.get(chr(c), 1) for c in range(129)], np.int64)


def labelled_findings(n: int = 6000, seed: int = 7) -> list[tuple[str, int, int, int]]:
    """(text, start, end, label): secrets of many shapes, short ones next to words that tell of them, and words, names,
    paths, addresses and numbers."""
    rng = np.random.default_rng(seed)
    pick = lambda chars, size: "".join(rng.choice(list(chars), size))
    lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    onsets = ["", "", "", "b", "c", "d", "f", "g", "h", "j", "l", "m", "n", "p", "r", "s", "t", "v", "w", "y", "z", "k", "th", "wh", "sh", "st", "tr", "pr", "ch", "sch", "gr", "qu", "bl", "ll", "ss"]
    codas = ["", "", "", "n", "r", "s", "t", "l", "m", "d", "nd", "ng", "x", "ck", "st", "th", "sh", "ly", "tion", "nt", "rs", "ß"]
    vowels = [*"aaeeeeiioouy", "ou", "ie", "ei", "ea", "au", "ä", "é", "ü", "ó", "ö", "ñ"]
    part = lambda: str(rng.choice(onsets)) + str(rng.choice(vowels)) + str(rng.choice(codas))
    word = lambda: "".join(part() for _ in range(rng.integers(1, 5)))
    num = lambda a, b: str(rng.integers(a, b))
    every = lower + upper + digits

    def mixed(chars: str, low: int, high: int) -> str:
        return pick(lower, 1) + pick(upper, 1) + pick(digits, 1) + pick(chars, rng.integers(low, high))

    secrets = [
        lambda: pick(every, rng.integers(20, 48)),
        lambda: pick(lower + upper, rng.integers(18, 40)),
        lambda: mixed(every, 5, 13),
        lambda: mixed(every + "!$%&#@*?^", 8, 16),
        lambda: pick(every + "!$%&#@*?^", rng.integers(10, 20)),
        lambda: pick(every + "+/", rng.integers(22, 64)) + "=" * int(rng.integers(0, 3)),
        lambda: str(rng.choice(["ghp_", "sk_live_", "xoxb-", "glpat-", "pk_test_"])) + pick(every, rng.integers(20, 40)),
        lambda: "eyJ" + pick(every, 20) + "." + pick(every + "_-", rng.integers(20, 60)),
        lambda: pick(upper + digits, rng.integers(16, 40)),
        lambda: word() + ":" + mixed(every, 3, 9) + "@" + word(),
        lambda: "~" + word() + mixed(every, 5, 12),
    ]
    harmless = [
        lambda: "/".join([word() for _ in range(3)]) + "/" + word() + num(1, 99) + ".html",
        lambda: f"mail{num(1, 99)}.{word()}.{rng.choice(['com', 'org', 'net'])}",
        lambda: f"{word()}.{word()}@{word()}.{rng.choice(['com', 'org', 'net'])}",
        lambda: f"{num(1990, 2030)}-{num(10, 13)}-{num(10, 29)}T{num(10, 24)}.{num(10, 60)}.{num(10, 60)}Z",
        lambda: f"{num(10**5, 10**9)}", lambda: f"+{num(1, 99)}-{num(100, 999)}-{num(1000, 9999)}",
        lambda: f"{word()}-{word()}_{word()}-v{num(1, 9)}.{num(0, 20)}.{num(0, 20)}",
        lambda: f"https://www.{word()}{num(1, 9)}.example.com/{word()}/{num(1, 999)}",
        lambda: "_".join([word(), word(), word(), num(1, 99)]),
        lambda: str(rng.choice(["=", "-", "#", "*", "$%", "&|"])) * 12,
        lambda: word().upper() + word().upper(), lambda: "<" + word() + ">" + word() + "</" + word() + ">",
    ]
    plain = lambda: word() + word() + str(rng.choice(["", "", "", ".", ",", ";", "?", ")"]))
    out = []
    for k in range(n):
        token = ""
        while len(token) < LEAST:
            if k % 3 == 0:
                token = secrets[int(rng.integers(0, len(secrets)))]()
            elif k % 3 == 1:
                token = plain() if rng.random() < 0.7 else plain().capitalize()
            else:
                token = harmless[int(rng.integers(0, len(harmless)))]()
        before = " ".join(word() for _ in range(rng.integers(0, 6)))
        before += str(rng.choice([" pwd: ", " key ", " = ", ": ", " login ", ' "'] if k % 3 == 0 and rng.random() < 0.5 else [" ", " ", ": ", ' "', "\n"]))
        text = before + token + str(rng.choice([" ", " ", ".\n", " "])) + " ".join(word() for _ in range(rng.integers(0, 6)))
        if k % 3 and rng.random() < 0.2:  # harmless tokens next to secrets, too
            text += " " + secrets[int(rng.integers(0, len(secrets)))]()
        out.append((text, len(before), len(before) + len(token), int(k % 3 == 0)))
    return out


def window(text: str, start: int, end: int) -> np.ndarray:
    """Classes of the whole candidate and of CONTEXT characters on both sides, and what the kernel needs beyond."""
    edge = CONTEXT + WIDTH // 2
    left, right = max(0, start - edge), min(len(text), end + edge)
    return np.concatenate([np.zeros(edge - start + left, np.int64), codes(text[left:right]), np.zeros(edge - right + end, np.int64)])


def pools(active: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Maximum and mean of the rows of each range: two overlapping ranges of a power of two cover one."""
    sums = np.vstack([np.zeros(FILTERS), np.cumsum(active, 0, np.float64)])
    most = np.empty((len(starts), FILTERS))
    top, reach = active, 1
    while True:
        mine = (sizes >= reach) & (sizes < 2 * reach)
        most[mine] = np.maximum(top[starts[mine]], top[starts[mine] + sizes[mine] - reach])
        if not (sizes >= 2 * reach).any():
            return np.hstack([most, (sums[starts + sizes] - sums[starts]) / sizes[:, None]])
        top, reach = np.maximum(top[: len(top) - reach], top[reach:]), 2 * reach


class Network:
    """One convolution, its maximum and mean over the window and over the candidate, one logistic unit, calibration."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.kernel = rng.normal(0, 0.3, (WIDTH, CLASSES, FILTERS))
        self.bias = np.zeros(FILTERS)
        self.out = rng.normal(0, 0.1, 4 * FILTERS)
        self.shift, self.scale, self.offset, self.threshold = 0.0, 1.0, 0.0, 0.5

    def forward(self, x: np.ndarray):
        n = len(x) - WIDTH + 1
        z = self.bias + sum(self.kernel[k][x[k : k + n]] for k in range(WIDTH))
        active = np.maximum(z, 0)
        own = active[CONTEXT : n - CONTEXT]
        pooled = np.concatenate([active.max(0), active.mean(0), own.max(0), own.mean(0)])
        return active, pooled, float(pooled @ self.out + self.shift)

    def probability(self, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.scale * self.forward(x)[2] + self.offset, -30, 30))))

    def probabilities(self, text: str, spans: list[tuple[int, int]]) -> np.ndarray:
        """``probability`` of each window; the convolution of a stretch of text is shared by its candidates."""
        out, at = np.zeros(len(spans)), 0
        kernel, bias = self.kernel.astype(np.float32), self.bias.astype(np.float32)
        while at < len(spans):
            to = at + 1
            while to < len(spans) and spans[to][1] - spans[at][0] <= STRETCH:
                to += 1
            x = window(text, spans[at][0], spans[to - 1][1])
            n = len(x) - WIDTH + 1
            active = np.maximum(bias + sum(kernel[k][x[k : k + n]] for k in range(WIDTH)), 0)
            begins = np.array([a - spans[at][0] for a, _ in spans[at:to]])
            lengths = np.array([b - a for a, b in spans[at:to]])
            pooled = np.hstack([pools(active, begins, lengths + 2 * CONTEXT), pools(active, begins + CONTEXT, lengths)])
            out[at:to] = pooled @ self.out + self.shift
            at = to
        return 1 / (1 + np.exp(-np.clip(self.scale * out + self.offset, -30, 30)))

    def learn(self, examples: list[tuple[np.ndarray, int]], rounds: int = 4, rate: float = 0.03, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        for turn in range(rounds):
            step = rate / (1 + turn)
            for i in rng.permutation(len(examples)):
                x, y = examples[i]
                active, pooled, score = self.forward(x)
                error = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - y
                n = len(active)
                grad = np.zeros_like(active)
                for part, (one, mean) in ((slice(None), (0, 1)), (slice(CONTEXT, n - CONTEXT), (2, 3))):
                    seen, share = grad[part], active[part]
                    weights = self.out.reshape(4, FILTERS)
                    seen[share.argmax(0), np.arange(FILTERS)] += error * weights[one]
                    seen += error * weights[mean] / len(share)
                grad *= active > 0
                self.out -= step * (error * pooled + 1e-4 * self.out)
                self.shift -= step * error
                self.bias -= step * grad.sum(0)
                for k in range(WIDTH):
                    np.subtract.at(self.kernel[k], x[k : k + n], step * grad)

    def calibrate(self, examples: list[tuple[np.ndarray, int]], recall: float) -> None:
        """Platt scaling by gradient steps, then the highest threshold with the recall."""
        s = np.array([self.forward(x)[2] for x, _ in examples])
        y = np.array([label for _, label in examples])
        for _ in range(400):
            p = 1 / (1 + np.exp(-np.clip(self.scale * s + self.offset, -30, 30)))
            self.scale -= 0.05 * float(((p - y) * s).mean())
            self.offset -= 0.05 * float((p - y).mean())
        p = np.sort(1 / (1 + np.exp(-np.clip(self.scale * s[y == 1] + self.offset, -30, 30))))
        self.threshold = float(p[int(np.floor((1 - recall) * len(p)))])


def trained(recall: float = RECALL, n: int = 6000) -> Network:
    examples = [(window(t, a, b), y) for t, a, b, y in labelled_findings(n)]
    cut = len(examples) * 3 // 4
    network = Network()
    network.learn(examples[:cut])
    network.calibrate(examples[cut:], recall)
    return network


def scanned(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_cnn of every row; an empty table gives no rows.

    A null or empty text has no findings (the hash is that of no bytes). Spans count code points. Texts
    are scanned whole, each for itself, so equal rows get equal results; other columns are not read.
    """
    network = network or trained()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                base = base_spans(text) if text else []
                tokens = candidates(text, base) if text else []
                chances = network.probabilities(text, tokens)
                more = [(a, "cnn", b) for (a, b), p in zip(tokens, chances, strict=True) if p >= network.threshold]
                every = sorted([*base, *more], key=lambda s: (s[0], ORDER[s[1]]))
                told = [",".join(f"{k}:{a}:{b}" for a, k, b in some) for some in (base, every)]
                n = [sum(k == kind for _, k, _ in base) for kind in KINDS]
                rows.append((doc_id, *n, hashlib.sha256(told[0].encode()).hexdigest(), told[1], len(more)))
            yield pd.DataFrame(rows, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_cnn"])

    schema = "doc_id string, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_cnn long"
    return with_ids_as_text(docs.select("doc_id", "text"), run, schema, "doc_id")
