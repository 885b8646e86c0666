"""SentencePiece encoding and decoding with the n best segmentations of a text.

The lattice of a text has an arc for each piece of the vocabulary that occurs in it, and byte arcs where no
piece fits a character. Forward Viterbi scores give the best score from the start to each position. They are
exact heuristics for a backward A* search from the end, so it pops the n best paths in order of score.

No piece holds a word mark after another character, or a line end (checked when the vocabulary is read), so
every path passes through the place before each word and around each line end; none holds punctuation beside
other characters (those that do share a piece with it count as punctuation), so every path passes between the
two. At these places the lattice of a text falls apart. Viterbi runs on each distinct word that a task
remembers; one pass back over the same arcs gives what a word's second best path loses. Only the n words of a text that lose least can differ in its n best paths; A* runs on those, and the n
best of the text are the least-cost choices among their alternatives, popped from one heap. The result is the
same as a search over the whole lattice.

Scores are unigram log-probabilities. The published vocabulary has merge ranks instead, in which a text's sum says
nothing of its likelihood; so a piece of rank r gets the probability that Zipf's law gives the r-th most frequent of
so many, and a byte piece less than any. Scores are rounded to 2**-20, so sums are exact and equal paths tie. Nothing is trained.

Defined results: null and empty texts have no pieces and one path of score 0. Encoding escapes spaces only
and adds one at the start, so decoding gives back every text exactly. Texts are encoded whole. Repeated rows
give repeated results. Extra columns are ignored.
"""

from __future__ import annotations

import gc
import heapq
import itertools
import math
import re
from collections.abc import Sequence

import ahocorasick
from pyspark.sql import DataFrame

from placeforge.llm.common import map_columns

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
N_BEST = 4
MARK = "▁"
#: What a byte piece scores below the least of the others.
BYTE_LOSS = 10.0
#: Distinct words that one worker process remembers, and as many again from before; longer ones are searched each time.
REMEMBERED, LONGEST_REMEMBERED = 200_000, 64
#: Characters that no piece should hold beside others.
PUNCTUATION = frozenset(c for c in map(chr, range(33, 127)) if not c.isalnum())


def log_probability(rank: int, total: float) -> float:
    """Of the piece with so many ranks before it, by Zipf's law; total is the sum of 1 / k over all pieces."""
    return round(-math.log((rank + 1) * total) * 2**20) / 2**20


class Vocabulary:
    """Pieces with scores, and byte pieces."""

    def __init__(self, pieces: dict[str, tuple[int, float]], bytes_: list[int], names: list[str]):
        self.pieces, self.bytes, self.names = pieces, bytes_, names
        self.byte_score = min((w for _, w in pieces.values()), default=0.0) - BYTE_LOSS
        # Every start of a piece, with the piece itself where it is one.
        self.starts: dict[str, tuple[int, float] | None] = {}
        for p in pieces:
            for k in range(1, len(p)):
                self.starts.setdefault(p[:k], None)
        self.starts.update(pieces)
        self.singles = frozenset(p for p in pieces if len(p) == 1)
        self.automaton = ahocorasick.Automaton()
        for p, (k, w) in pieces.items():
            self.automaton.add_word(p, (len(p), (k,), w))
        if pieces:
            self.automaton.make_automaton()
        self.is_byte = [False] * len(names)
        for k in bytes_:
            self.is_byte[k] = bool(pieces) and names[k].startswith("<0x")
        self.raw = [bytes([int(p[3:5], 16)]) if self.is_byte[k] else p.encode("utf-8") for k, p in enumerate(names)]
        self.byte_of = {k: b for b, k in enumerate(bytes_)}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in pieces):
            raise ValueError("a piece spans words")
        # Characters that share a piece with punctuation, marks aside, count as punctuation too.
        apart, grown = set(PUNCTUATION), True
        while grown:
            mixed = [set(p) - {MARK} for p in pieces if not apart.isdisjoint(p)]
            new = set().union(*mixed) - apart
            apart |= new
            grown = bool(new)
        inner = "".join(map(re.escape, sorted(apart)))
        self.words = re.compile(f"{MARK}*[^{inner}{MARK}\n]+|{MARK}*[{inner}]+|{MARK}+|\n").findall

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [sp.id_to_piece(k) for k in range(sp.get_piece_size())]
        pieces, bytes_ = {}, [0] * 256
        for k, p in enumerate(names):
            if sp.is_byte(k):
                bytes_[int(p[3:5], 16)] = k
            elif not (sp.is_control(k) or sp.is_unknown(k) or sp.is_unused(k)):
                pieces[p] = (k, -sp.get_score(k))
        total = sum(1 / k for k in range(1, len(pieces) + 1))
        ranked = sorted(pieces.items(), key=lambda x: (x[1][1], x[1][0]))
        return cls({p: (k, log_probability(rank, total)) for rank, (p, (k, _)) in enumerate(ranked)}, bytes_, names)


def arcs(word: str, voc: Vocabulary) -> list[tuple[int, int, tuple[int, ...], float]]:
    """(start, end, ids, score) of every arc; by end from the automaton, by start where bytes are needed."""
    if voc.singles.issuperset(word):
        return [(e + 1 - k, e + 1, i, w) for e, (k, i, w) in voc.automaton.iter(word)]
    out, n, get = [], len(word), voc.starts.get
    for s in range(n):
        single = False
        for e in range(s + 1, n + 1):
            p = get(word[s:e], 0)
            if p == 0:
                break
            if p is not None:
                single |= e == s + 1
                out.append((s, e, (p[0],), p[1]))
        if not single:
            raw = word[s].encode("utf-8", "surrogatepass")
            out.append((s, s + 1, tuple(voc.bytes[b] for b in raw), voc.byte_score * len(raw)))
    return out


def viterbi(word: str, voc: Vocabulary) -> tuple[float, tuple[int, ...], float, int]:
    """Best score, its ids, the loss of the second best path (infinite where there is one path only), byte pieces."""
    n, low = len(word), float("-inf")
    ahead, came, lattice = [0.0] + [low] * n, [None] * (n + 1), []
    add, plain = lattice.append, voc.singles.issuperset(word)
    if plain:  # one pass of the automaton finds all arcs, by end
        for e, (k, i, w) in voc.automaton.iter(word):
            e += 1
            s = e - k
            v = ahead[s] + w
            if v > ahead[e]:
                ahead[e] = v
                came[e] = (s, i)
            add((s, e, w, v))
    else:
        for s, e, i, w in sorted(arcs(word, voc), key=lambda x: x[1]):
            v = ahead[s] + w
            if v > ahead[e]:
                ahead[e] = v
                came[e] = (s, i)
            add((s, e, w, v))
    at, back_ids, on = n, [], {}
    while at:
        s, i = came[at]
        back_ids.append(i)
        on[at] = s
        at = s
    ids = tuple([k for i in reversed(back_ids) for k in i])
    # Any other path has an arc off the best one; the best path through an arc is known from both sides.
    best, second, back = ahead[n], low, [low] * n + [0.0]
    for s, e, w, v in reversed(lattice):
        b = back[e]
        if w + b > back[s]:
            back[s] = w + b
        v += b
        if v > second and (v < best or on.get(e) != s):
            second = v
    return best, ids, best - second, 0 if plain else sum(voc.is_byte[i] for i in ids)


def n_best(word: str, voc: Vocabulary, n: int = N_BEST) -> list[tuple[float, tuple[int, ...]]]:
    """The n best (score, ids) of one lattice, best first, by A* back from the end."""
    into: list[list] = [[] for _ in range(len(word) + 1)]
    ahead = [0.0] + [float("-inf")] * len(word)
    for s, e, ids, w in sorted(arcs(word, voc), key=lambda x: x[0]):
        into[e].append((s, ids, w))
        ahead[e] = max(ahead[e], ahead[s] + w)
    # (-(score back from the end + exact best before), tie, place, score so far, path as a linked list).
    # Of equal entries the newest goes first, so ties are followed to their end and not all at once.
    heap: list = [(-ahead[-1], 0, len(word), 0.0, None)]
    out: list[tuple[float, tuple[int, ...]]] = []
    tie = 0
    while heap and len(out) < n:
        _, _, at, score, path = heapq.heappop(heap)
        if at == 0:
            ids = []
            while path is not None:
                ids += path[0]
                path = path[1]
            out.append((score, tuple(ids)))
            continue
        for s, ids, w in into[at]:
            tie -= 1
            heapq.heappush(heap, (-(ahead[s] + score + w), tie, s, score + w, (ids, path)))
    return out


def words_of(text: str, voc: Vocabulary) -> list[str]:
    """The escaped text, cut where every path passes."""
    return voc.words(MARK + text.replace(" ", MARK)) if text else []


class Encoder:
    """n best segmentations of whole texts, with a memory of words."""

    def __init__(self, voc: Vocabulary, n: int = N_BEST):
        self.voc, self.n, self.known, self.older, self.others = voc, n, {}, {}, {}

    def look(self, words: list[str]) -> list[tuple[float, tuple[int, ...], float, int]]:
        """viterbi() of each word."""
        if len(self.known) > REMEMBERED:  # words met since the last time stay for one more
            self.older, self.known, self.others = self.known, {}, {}
        known, older, voc = self.known, self.older, self.voc
        long = {}
        for w in set(words).difference(known):
            if len(w) > LONGEST_REMEMBERED:
                long[w] = viterbi(w, voc)
            else:
                known[w] = older.get(w) or viterbi(w, voc)
        return [known.get(w) or long[w] for w in words]

    def other(self, word: str, best: float, ids: tuple[int, ...]) -> list[tuple[float, tuple[int, ...] | None]]:
        """(loss, ids) of a word's alternatives, the best path (None) first."""
        known = self.others.get(word)
        if known is None:
            # n + 1 of them, as the best one may stand anywhere among its equals.
            found = [(best - s, i) for s, i in n_best(word, self.voc, self.n + 1) if i != ids]
            known = [(0.0, None), *found][: self.n]
            if len(word) <= LONGEST_REMEMBERED:
                self.others[word] = known
        return known

    def paths(self, text: str | None) -> tuple[list[tuple], list[tuple[float, dict[int, tuple[int, ...]]]]]:
        """The best path by words, and the n best as (score, {word index: its other ids}), best first."""
        words = words_of(text or "", self.voc)
        found = self.look(words)
        score = sum([x[0] for x in found])
        losses = [x[2] for x in found]
        places = [k for k in heapq.nsmallest(self.n - 1, range(len(found)), key=losses.__getitem__) if losses[k] != float("inf")]
        options = [self.other(words[k], *found[k][:2]) for k in places]
        heap: list[tuple[float, tuple[int, ...]]] = [(0.0, (0,) * len(places))]
        seen, out = {heap[0][1]}, []
        while heap and len(out) < self.n:
            loss, pick = heapq.heappop(heap)
            out.append((score - loss, {k: options[j][p][1] for j, (k, p) in enumerate(zip(places, pick, strict=True)) if p}))
            for j in range(len(places)):
                if pick[j] + 1 < len(options[j]):
                    nxt = (*pick[:j], pick[j] + 1, *pick[j + 1 :])
                    if nxt not in seen:
                        seen.add(nxt)
                        heapq.heappush(heap, (loss - options[j][pick[j]][0] + options[j][pick[j] + 1][0], nxt))
        return found, out

    def encode(self, text: str | None) -> list[tuple[float, list[int]]]:
        """The n best of a text, best first."""
        found, out = self.paths(text)
        return [(s, [i for k, x in enumerate(found) for i in change.get(k, x[1])]) for s, change in out]

    def bytes_of(self, ids: Sequence[int]) -> bytes:
        raw = self.voc.raw
        return b"".join([raw[i] for i in ids])

    def decode(self, ids: Sequence[int]) -> str:
        """The text of a sequence of ids."""
        return self.bytes_of(ids).decode("utf-8", "surrogatepass").replace(MARK, " ")[1:]


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(model: str = MODEL, n: int = N_BEST) -> Encoder:
    """The process's own encoder, with what it remembers from earlier tasks."""
    if (model, n) not in _ENCODERS:
        _ENCODERS[model, n] = Encoder(Vocabulary.load(model), n)
    return _ENCODERS[model, n]


SCHEMA = (
    "doc_id long, n_chars long, n_pieces long, n_byte_pieces long, n_paths int, best_score double, last_score double, "
    "ids array<int>, second_at int, second_ids array<int>, exact boolean, "
    "paths array<struct<score: double, changes: array<struct<at: int, n: int, ids: array<int>>>, exact: boolean>>"
)


def encode_documents(df: DataFrame, model: str = MODEL, n: int = N_BEST, ids: bool = True) -> DataFrame:
    """The best ids of each row of df (doc_id, text), how each of the n best differs, and the round trip.

    `paths` has all n best in order. Each has, for every word it cuts otherwise than the best, the piece index of
    that word in the best ids, the number of pieces it has there, and the ids that stand in their place.

    The second path has other ids for one word: `second_at` is the piece index where that word starts,
    `second_ids` what it has there. `exact` says that the decoded ids are the text, of the best and in `paths` of each.
    With ids=False all id lists stay null. A mark character in the text itself can't be told from an escaped space, so `exact` is false there.
    """

    def make():
        enc = encoder(model, n)

        def run(doc_ids, texts):
            # Words are remembered in tuples without cycles; the collector would walk them again and again.
            gc.disable()
            rows = []
            for d, t in zip(doc_ids, texts, strict=True):
                t = t or ""
                found, paths = enc.paths(t)
                best = [i for x in found for i in x[1]]
                exact = enc.decode(best) == t
                at, other = None, None
                starts = [0, *itertools.accumulate([len(x[1]) for x in found])]
                every = []
                for score, change in paths:
                    # Other pieces of a word with the same bytes decode to the same text.
                    same = exact and all(enc.bytes_of(i) == enc.bytes_of(found[k][1]) for k, i in change.items())
                    every.append((score, [(starts[k], len(found[k][1]), list(i) if ids else None) for k, i in sorted(change.items())], same))
                if len(paths) > 1:  # the second path changes one word
                    ((k, other),) = paths[1][1].items()
                    at = starts[k]
                    other = list(other)
                n_bytes = sum([x[3] for x in found])
                rows.append((d, len(t), len(best), n_bytes, len(paths), paths[0][0], paths[-1][0], best if ids else None, at, other if ids else None, exact, every))
            gc.enable()
            return list(map(list, zip(*rows, strict=True)))

        return run

    return map_columns(df, ("doc_id", "text"), SCHEMA, make)
