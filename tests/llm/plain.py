"""Plain Python versions of the operators, one text or one table at a time."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
import tiktoken


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def lower(text: str) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def ascii_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def byte_bpe():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def piece_bpe():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def tokens_of(texts: dict) -> dict:
    encoding = byte_bpe()
    out = {}
    for key, text in texts.items():
        ids = encoding.encode_ordinary(text or "")
        out[key] = (len(ids), sha(" ".join(map(str, ids))), sha(text or ""))
    return out


def luhn(digits: str) -> bool:
    doubled = [int(d) * 2 if k % 2 else int(d) for k, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The patterns as they are stated."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def shingles(text: str) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", lower(text or ""))
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def groups(texts: dict) -> dict:
    """doc -> (number of shingles, least doc that links reach)."""
    sets = {d: shingles(t) for d, t in texts.items()}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    keys, common = defaultdict(list), Counter()
    for d, s in sets.items():
        for x in s:
            keys[x].append(d)
    for docs in keys.values():
        common.update((a, b) for i, a in enumerate(docs) for b in docs[i + 1 :])
    for (a, b), n in common.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {d: (len(s), root(d)) for d, s in sets.items()}


def line_key(line: str) -> str:
    return lower(line.strip("\t\n\x0b\f\r "))


def clean_lines(texts: dict, min_docs: int = 3) -> dict:
    """doc -> (lines, dropped, kept text)."""
    holders = defaultdict(set)
    for d, t in texts.items():
        for line in (t or "").split("\n"):
            if len(line_key(line)) >= 20:
                holders[line_key(line)].add(d)
    out = {}
    for d, t in texts.items():
        lines = (t or "").split("\n")
        stay = [x for x in lines if len(h := holders.get(line_key(x), ())) < min_docs or max(h) == d]
        out[d] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    return out


def hits(texts: dict, items: dict) -> dict:
    """doc -> (words, hit words, items)."""

    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))

    windows = defaultdict(set)
    for item, t in items.items():
        w = words(t)
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[i : i + n])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for d, t in texts.items():
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                of = windows.get(tuple(w[i : i + n]))
                if of:
                    hit |= set(range(i, i + n))
                    found |= of
        out[d] = (len(w), len(hit), sorted(found))
    return out


def repeats(text: str) -> dict:
    """All measures of the quality rules, by comparing words themselves."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    chars = list(map(len, words))

    def inside(n, later):
        seen = Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
        before, marked = set(), set()
        for i in range(len(words) - n + 1):
            w = tuple(words[i : i + n])
            if (w in before) if later else seen[w] > 1:
                marked |= set(range(i, i + n))
            before.add(w)
        return marked

    seen, dup_lines, dup_chars = set(), 0, 0
    for line in (text or "").split("\n"):
        own = re.findall(r"[^\x20\x09-\x0D]+", line)
        if own and line in seen:
            dup_lines, dup_chars = dup_lines + 1, dup_chars + sum(map(len, own))
        seen.add(line)
    out = {
        "n_words": len(words),
        "word_chars": sum(chars),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text or "")),
        "n_dup_lines": dup_lines,
        "n_repeat_words": len(inside(3, False)),
        "dup_line_chars": dup_chars,
    }
    return out | {f"rep{n}_chars": sum(chars[i] for i in inside(n, True)) for n in (5, 7, 10)}


def good(text: str) -> bool:
    m = repeats(text)
    if m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]:
        return False
    limits = {"dup_line_chars": 20, "rep5_chars": 15, "rep7_chars": 14, "rep10_chars": 10}
    return all(100 * m[k] <= v * m["word_chars"] for k, v in limits.items())


def pipeline(texts: dict, items: dict) -> dict:
    """The whole corpus pipeline: doc -> (tokens, digest of ids, digest of the decoded text)."""
    kept = {d: t for d, t in texts.items() if good(t)}
    kept = {d: x[2] for d, x in clean_lines(kept).items()}
    near = groups(kept)
    kept = {d: t for d, t in kept.items() if near[d][1] == d}
    found = hits(kept, items)
    return tokens_of({d: t for d, t in kept.items() if not found[d][1]})
