"""Brute-force versions of what the queries return, row by row in plain Python."""

from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

WORD = re.compile("[^\x20\x09-\x0d]+")


def hexed(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def word_bpe():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def encode(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def op2(rows):
    tok = word_bpe()
    out = []
    for doc_id, text in rows:
        ids = encode(tok, text)
        out.append((doc_id, len(ids), hexed(np.array(ids, "<u4").tobytes()), hexed(tok.decode(ids, skip_special_tokens=False).encode())))
    return sorted(out, key=str)


def op3(rows, n=35):
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    seen = Counter(tuple(w[k : k + n]) for _, w in docs for k in range(len(w) - n + 1))
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - n + 1):
            if seen[tuple(w[k : k + n])] > 1:
                gone[k : k + n] = [True] * n
        out.append((i, len(w), sum(gone), hexed(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode())))
    return sorted(out, key=str)


def op4(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(max(fit)[1:] if fit else (None, None)))


def url_tokens(url):
    host, path, *_ = op4(url, [])
    rest = (url or "").split("://", 1)[-1]
    query = rest.split("#")[0].partition("?")[2]
    kind = re.search("(/|[.][a-z0-9]{1,5})$", path)
    parts = {*(f"h:{x}" for x in host.split(".") if x), *(f"p:{re.sub('[0-9]+', '0', x)}" for x in path.split("/") if x), *(f"q:{x.split('=')[0]}" for x in query.split("&") if x), f"e:{kind[0] if kind else ''}"}
    return parts if host else set()


def mined(rows, marks, min_confidence=0.8, min_lift=1.2, told=8, z=1.645):
    """Verdicts by all combinations of the tokens of each URL that tell most of the labels: support,
    confidence and lift counted over all URLs with tokens."""
    sets = {i: url_tokens(u) for i, u in rows}
    size = sum(map(bool, sets.values()))
    least = max(np.ceil(0.005 * size), np.ceil(z * z * min_confidence / (1 - min_confidence)))
    where = {}
    for i, s in sets.items():
        for t in s:
            where.setdefault(t, set()).add(i)
    of = {v: {i for i, m in marks.items() if m == v and sets[i]} for v in ("block", "allow")}
    tells = {t: max(abs(len(w & o) - len(w) * len(o) / size) for o in of.values()) for t, w in where.items() if len(w) >= least}
    same = {}
    for t in sorted(tells):
        same.setdefault(frozenset(where[t]), t)
    first = {t: same[frozenset(where[t])] for t in tells}
    order = lambda s: sorted({first[t] for t in s if t in first}, key=lambda t: (-round(tells[t], 6), t))[:told]
    freq = Counter()
    for i, s in sets.items():
        ts = sorted(order(s))
        for n in range(1, len(ts) + 1):
            for some in itertools.combinations(ts, n):
                freq[some, None] += 1
                if i in marks:
                    freq[some, marks[i]] += 1
    rules = {}
    for (some, v), c in freq.items():
        n = freq[some, None]
        conf = c / n
        low = (conf + z * z / (2 * n) - z * (conf * (1 - conf) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)
        if v and c >= least and low >= min_confidence and conf / (len(of[v]) / size) >= min_lift:
            rules[some, v] = conf
    out = {}
    for i, s in sets.items():
        best = {v: max((c for (some, w), c in rules.items() if w == v and set(some) <= s), default=0.0) for v in ("block", "allow")}
        out[i] = "block" if best["block"] > best["allow"] else "allow"
    return out


def op5(rows, min_docs=10, signature=None):
    """Whole templates by exact counting; general ones by their definition: the distinct lines of a
    group are laid side by side. ``signature``: of the set of whole templates and groups that recur in a text with
    too few shingles of its own; by default the set itself."""
    masked = lambda w: None if set(w.encode()) & set(b"0123456789@=\\") else w
    pairs = list(itertools.combinations(range(4), 2))
    counted = lambda x: any(w is not None for w in x) or len(x) >= 4
    texts = {}
    for _, t in rows:
        texts[t] = [tuple(map(masked, WORD.findall(x))) for x in t.split("\n")] if t else []

    def groups_of(x):
        inside = lambda p, k: 4 * p // len(x) in pairs[k]
        return [(len(x), k, tuple((p, w) for p, w in enumerate(x) if inside(p, k))) for k in range(6)] if len(x) >= 4 else []

    keys = lambda x: [x, *groups_of(x)] if counted(x) else []
    where = {}
    for t, lines in texts.items():
        for x in lines:
            for key in keys(x):
                where.setdefault(key, set()).add(t)
    many = {k for k, v in where.items() if len(v) >= min_docs}
    name = {}
    for t, lines in texts.items():
        words, own = sum(map(len, lines)), 0
        for x in lines:
            covered = {q for b in keys(x)[1:] if b in many for q in pairs[b[1]]}
            if counted(x) and x in many:
                covered = {0, 1, 2, 3}
            if not covered:
                own += len(x)
            for q in set(range(4)) - covered if covered else ():
                own += sum(4 * p // len(x) == q for p in range(len(x))) + 4 * (q - 1 in covered or q == 0)
        mine = frozenset(many.intersection(*[[k for x in lines for k in keys(x)]]))
        name[t] = t if own >= 0.25 * max(1, words - 4) else (signature or (lambda z: z))(mine)
    often = {k for k in many if len({name[t] for t in where[k]}) >= min_docs}
    groups = {}
    for lines in texts.values():
        for x in lines:
            for b in keys(x)[1:]:
                if b in often:
                    groups.setdefault(b, set()).add(x)
    templates = {}
    for b, kinds in groups.items():
        held = {p for p, _ in b[2]}
        fixed = {}
        for p in set(range(b[0])) - held:
            token, c = Counter(x[p] for x in kinds).most_common(1)[0]
            if c >= 0.9 * len(kinds):
                fixed[p] = token
        literal = sum(w is not None for _, w in b[2]) + sum(w is not None for w in fixed.values())
        if len(fixed) + len(held) < b[0] and literal >= 0.7 * b[0]:
            templates[b] = fixed
    out = []
    for i, t in rows:
        lines = t.split("\n") if t else []
        gone = [x in often or any(b in templates and all(x[p] == w for p, w in templates[b].items()) for b in keys(x)[1:]) for x in texts[t]]
        kept = [raw for raw, x, z in zip(lines, texts[t], gone, strict=True) if not (z and counted(x))]
        out.append((i, len(lines), len(lines) - len(kept), hexed("\n".join(kept).encode())))
    return sorted(out, key=str)


def op6(rows, limit=4096):
    import sentencepiece as spm

    sp = spm.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for doc_id, text in rows:
        n = len(sp.encode(text or ""))
        out.append((doc_id, len((text or "").encode()), n, n > limit))
    return sorted(out, key=str)


def op7(rows, k=20, every=20):
    """rows: (vec_id, list). Exact neighbours."""
    good = [(i, np.array(v, np.float64)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and np.any(np.array(v, float))]
    ids = np.array([i for i, _ in good])
    x = np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % every == 0:
            s = x @ v
            order = [j for j in np.lexsort((ids, -np.round(s, 12))) if ids[j] != i][:k]
            out[int(i)] = [int(ids[j]) for j in order]
    return out


def op8_ids(rows, end=2):
    tok = word_bpe()
    return {i: np.array([*encode(tok, t), end], "<u4") for i, t in rows}


def check_packing(pieces, docs, window=4096):
    """pieces: dicts of the query's columns; docs: doc_id -> ids. Asserts the contract and returns
    the share of padding."""
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
        by_seq.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(docs)
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(docs[i]) and p["length"] > 0
            assert p["ids_crc32"] == zlib.crc32(docs[i][at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(docs[i])
    padding = total = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / max(1, total)


def op9(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    wins = Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
    hit = [False] * len(w)
    for k in range(len(w) - 4):
        if wins[tuple(w[k : k + 5])] > 1:
            hit[k : k + 5] = [True] * 5
    rep = sum(hit)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), rep, len(w) < 10 or 100 * rep > 20 * len(w))


def least_determinant(x, h, factor, floors):
    """(determinant, mean, scatter) of the subset of h rows whose scatter has the least determinant."""
    best = None
    for some in itertools.combinations(range(len(x)), h):
        y = x[list(some)]
        scatter = factor * np.cov(y.T, bias=True) + np.diag(floors)
        det = np.linalg.det(scatter)
        if best is None or det < best[0]:
            best = det, y.mean(0), scatter
    return best


def shingles(text, n=5):
    w = (text or "").split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
