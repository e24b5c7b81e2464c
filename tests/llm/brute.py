"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes | str) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """n_bytes, n_removed, n_spans, digest of what is kept, for each text."""
    data = [(t or "").encode() for t in texts]
    starts = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if starts[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, sha(kept)))
    return out


def base_quality(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    symbols = sum(c in "#*$%&|<>" for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def base_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end), by start, then kind."""
    text = text or ""
    assign = re.compile(
        r"((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|"
        r"(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    found = [(m.start(), 0, "assign", m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def simhash(text: str | None) -> int:
    words = [w.decode() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(prints: list[int], radius: int = 2) -> list[int]:
    """For each fingerprint the smallest position that it can reach."""
    parent = list(range(len(prints)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(prints))]


def contaminated_words(text: str | None, items: list[str | None], window: int = 10) -> set[int]:
    def words(t):
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)

    found: set[int] = set()
    own = words(text)
    for item in items:
        w = words(item)
        for part in [w[i : i + window] for i in range(max(1, len(w) - window + 1))] if w else []:
            for i in range(len(own) - len(part) + 1):
                if own[i : i + len(part)] == part:
                    found.update(range(i, i + len(part)))
    return found


def mixture(rows: list[tuple[int, str | None, str | None]]) -> dict[int, int]:
    """How often a mixture takes each of (id, text, source)."""
    size = {i: len(WORD.findall(t or "")) for i, t, _ in rows}
    sources = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sources)}
    total = {s: sum(size[i] for i, _, source in rows if source == s) for s in sources}
    target = dict.fromkeys(sources, 0.0)
    free, rest = set(sources), float(sum(total.values()))
    while free:
        share = rest / sum(weight[s] for s in free)
        above = {s for s in free if share * weight[s] >= 3 * total[s]}
        for s in above or free:
            target[s] = 3.0 * total[s] if above else share * weight[s]
        rest -= sum(3.0 * total[s] for s in above)
        free -= above or free
    copies = {}
    for s in sources:
        keyed = []
        for i, text, source in rows:
            if source == s:
                text = text or ""
                quality = max(0.1, len(re.sub("[#*$%&|<>!0-9]+", "", text)) / len(text)) if text else 1.0
                digest = hashlib.md5(f"mix-1:{i}:{hashlib.md5(text.encode()).hexdigest()}".encode()).hexdigest()
                keyed.append((-math.log((int(digest[:13], 16) + 0.5) / 2**52) / quality, i))
        epochs = int(target[s] // total[s]) if total[s] else 0
        rest_of_it, upto = target[s] - epochs * total[s], 0
        for _, i in sorted(keyed):
            upto += size[i]
            copies[i] = epochs + (size[i] > 0 and upto - size[i] / 2 <= rest_of_it)
    return copies


def alignment(texts: list[str | None]):
    """Rows (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), documents and links of each pair of ids."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printing = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in printing} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in printing)}
    entries = {i: bytes(letters[c] for c in token) for token, i in a.get_vocab(False).items()}

    def piece(i):
        written = b.id_to_piece(i)
        return bytes([int(written[3:5], 16)]) if b.is_byte(i) else written.replace("▁", " ").encode()

    found, held, all_links = [], Counter(), Counter()
    for text in texts:
        want = (" " + (text or "")).encode()
        sides = []
        for ids, of in ((a.encode(" " + (text or ""), add_special_tokens=False).ids, entries.get), (b.encode(text or ""), piece)):
            parts = [of(i) for i in ids]
            sides.append((ids, running(parts), b"".join(parts)))
        if not text or any(spelt != want for _, _, spelt in sides):
            found.append((0, 0, [], Counter()))
            continue
        cuts = sorted({*sides[0][1]} & {*sides[1][1]})
        groups = split_at(cuts, sides)
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        found.append((len(sides[0][0]), len(sides[1][0]), groups, links))
        held.update(links.keys())
        all_links.update(links)
    most = Counter()
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    rows = []
    for n_a, n_b, groups, links in found:
        written = ";".join(f"{','.join(map(str, left))}|{','.join(map(str, right))}" for left, right in groups)
        best = sum(n for key, n in links.items() if held[key] == most[key[0]])
        total = sum(n * held[key] for key, n in links.items())
        rows.append((n_a, n_b, len(groups), sum(links.values()), best, total, sha(written) if groups else ""))
    return rows, held, all_links


def running(parts: list[bytes]) -> list[int]:
    out, total = [], 0
    for part in parts:
        total += len(part)
        out.append(total)
    return out


def split_at(cuts: list[int], sides) -> list[list[list[int]]]:
    groups: list[list[list[int]]] = [[[], []] for _ in cuts]
    for k, (ids, ends, _) in enumerate(sides):
        at = 0
        for i, end in zip(ids, ends, strict=True):
            groups[at][k].append(i)
            at += end == cuts[at]
    return groups


def whitening(vectors: list[list[float]], count: int):
    """x per row, n, sums, eigenvalues and directions of the covariance of the distinct rows, and its trace."""
    import numpy as np

    x = [[math.floor(64 * float(c)) + 1_000_000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))))
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    covariance = centred.T @ centred / n
    values, directions = np.linalg.eigh(covariance)
    return np.array(x), n, sums, values[::-1][:count], directions[:, ::-1][:, :count], np.trace(covariance)


def weak_supervision(votes: list[list[int]], rounds: int, start=(0.93, 0.3, 0.8), weight: float = 20.0) -> list[float]:
    """Posterior of every document by plain expectation-maximisation over documents, not patterns."""
    for_good, against_bad, prior = start
    tables = [(for_good, against_bad)] * len(votes[0])

    def good_probability(row):
        odds = prior / (1 - prior)
        for vote, (good, bad) in zip(row, tables, strict=True):
            odds *= {1: good / (1 - bad), 0: 1.0, -1: (1 - good) / bad}[vote]
        return odds / (1 + odds)

    for _ in range(rounds):
        good = [good_probability(row) for row in votes]
        moved = []
        for rule in range(len(tables)):
            sums = Counter()
            for row, g in zip(votes, good, strict=True):
                sums[row[rule], 1] += g
                sums[row[rule], 0] += 1 - g
            a = (weight * for_good + sums[1, 1]) / (weight + sums[1, 1] + sums[-1, 1])
            b = (weight * against_bad + sums[-1, 0]) / (weight + sums[1, 0] + sums[-1, 0])
            a, b = (min(max(x, 1e-4), 1 - 1e-4) for x in (a, b))
            moved.append((a, max(b, 1 - a)))
        share = (weight * start[2] + sum(good)) / (weight + len(good))
        change = max(abs(x - y) for x, y in zip([share, *sum(moved, ())], [prior, *sum(tables, ())], strict=True))
        prior, tables = share, moved
        if change < 1e-4:
            break
    return [good_probability(row) for row in votes]


def stretches(values: list[float], offset: int = 0) -> list[tuple[int, int, float]]:
    """Ruzzo and Tompa's definition: the best stretch, then the same to its left and to its right."""
    upto = [0.0]
    for v in values:
        upto.append(upto[-1] + v)
    best = max(((upto[j] - upto[i], i - j, i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return [*stretches(values[:i], offset), (offset + i, offset + j - 1, best[0]), *stretches(values[j:], offset + j)]
