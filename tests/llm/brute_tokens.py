"""Plain versions of the token operators: whole texts through the libraries, all pairs of spans."""

from __future__ import annotations

import base64
import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
import tiktoken
from tokenizers import Tokenizer


def rank_encoding():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _letters():
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in plain]
    return {(chr(b) if b in plain else chr(256 + others.index(b))): b for b in range(256)}


def _ranges(tokens):
    out, at = [], 0
    for ident, data in tokens:
        out.append((ident, at, at + len(data)))
        at += len(data)
    return out


def alignments(docs):
    """(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of all (doc_id, text)."""
    byte = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    byte.encode_special_tokens = True
    piece = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = _letters()
    found = []
    for doc, text in docs:
        a = [(i, bytes(letters[c] for c in byte.id_to_token(i))) for i in byte.encode(" " + (text or ""), add_special_tokens=False).ids]
        b = []
        for i in piece.encode(text or ""):
            name = piece.id_to_piece(i)
            b.append((i, bytes([int(name[3:5], 16)]) if piece.is_byte(i) else name.replace("▁", " ").encode()))
        whole = (" " + (text or "")).encode()
        if not text or any(b"".join(d for _, d in side) != whole for side in (a, b)):
            a = b = []
        a, b = _ranges(a), _ranges(b)
        pairs, first = [], 0
        for i, low, high in a:
            while first < len(b) and b[first][2] <= low:
                first += 1
            k = first
            while k < len(b) and b[k][1] < high:
                pairs.append((i, b[k][0]))
                k += 1
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, at = [], [0, 0]
        for high in cuts:
            inside = []
            for which, side in enumerate((a, b)):
                first = at[which]
                while at[which] < len(side) and side[at[which]][2] <= high:
                    at[which] += 1
                inside.append(",".join(str(i) for i, *_ in side[first : at[which]]))
            groups.append("|".join(inside))
        found.append((doc, len(a), len(b), len(cuts), pairs, ";".join(groups)))
    count = Counter(p for *_, pairs, _ in found for p in set(pairs))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [(d, n, m, g, len(p), text, sum(count[x] == best[x[0]] for x in p), sum(count[x] for x in p)) for d, n, m, g, p, text in found]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest() if text else ""
