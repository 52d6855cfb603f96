"""Secret scans: fixed rules, and a linear-chain conditional random field that adds spans."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import string
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import holds, slices, texts_of

#: The rules and the lengths that their matches must have.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # as long as [0-9a-f]+ matches of 32 and more
ASSIGN_CHARS, ACCESS_CHARS = 8, 16
KINDS = ("assign", "access", "hex", "crf")
_HINTS = ("passw", "secret", "token", "api")
REDACTED = "[SECRET]"

OUT, BEGIN, IN = range(3)
PLACES = 4096
_KEYWORDS = r"pass|secret|token|key|credential|auth|bearer|private|aws|login"
_KEYWORD = re.compile(_KEYWORDS, re.IGNORECASE | re.ASCII)
#: Words that may announce a secret, which then stands within so many tokens.
_ASKS = "password passwords passwd passcode passphrase passwort pwd pw pin secret secrets token key apikey credential credentials bearer auth authorization login".split()
_ASK = rf"(?:^|[^a-z])(?:{'|'.join(_ASKS)})(?:$|[^a-z])"
_ASKING = re.compile(_ASK)
REACH = 4
#: A text's count of tokens with both a letter and a digit, or of this many characters, is a feature.
LONG_TOKEN = 24
_CANDIDATE = re.compile(rf"(?=\S*[0-9])(?=\S*[A-Za-z])\S{{8,}}|\S{{{LONG_TOKEN},}}")
LOOKS = ("word", "caps", "mixed", "digits", "alnum", "marked", "other")
LENGTHS, MANY = 9, 9
_EDGE = "\"'`.,;:!?()[]{}<>"
_ENDS = ":=,."
_ASCII_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the rules' matches, in order; code points, end exclusive."""
    out = []
    lower = text.lower()
    if any(h in lower for h in _HINTS):
        out += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_CHARS]
    if "AKIA" in text:
        out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= ACCESS_CHARS]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    out.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return out


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


@lru_cache(maxsize=8192)
def _place(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % PLACES


def _plain(core: str) -> bool:
    """A short word in lower case, perhaps with a first capital, or in capitals."""
    return 2 <= len(core) < LONG_TOKEN and core.isalpha() and (core[1:].islower() or core.isupper())


def shape_names(token: str) -> list[str]:
    """A token's own features: shape, mixture, entropy, marks."""
    core = token.strip(_EDGE)
    n = len(core)
    if _plain(core):  # no more than its length and case, which is quick
        names = [f"n{n // 4}", f"plain{core[0].isupper()}{core.isupper()}"]
        return [*names, "keyword"] if _KEYWORD.search(core) else names
    kinds = "".join("d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in core)
    runs = re.sub(r"(.)\1+", r"\1", kinds)
    entropy = -sum(c / n * math.log2(c / n) for c in map(core.count, set(core))) if n else 0
    turns = sum(a != b for a, b in itertools.pairwise(kinds))
    names = [f"n{min(n // 4, 12)}", f"has{''.join(sorted(set(kinds)))}", f"runs{min(len(runs) // 2, 12)}", f"ent{min(int(entropy * 2), 12)}", f"first{runs[:3]}", f"turns{min(8 * turns // max(n, 1), 8)}"]
    parts = re.split(r"[^A-Za-z0-9]+", core)
    longest = max(parts, key=len)
    mixed = any(c.isdigit() for c in longest) + any(c.isupper() for c in longest[1:]) + any(c.islower() for c in longest)
    names += [f"part{min(len(longest) // 4, 10)}:{mixed}", f"parts{min(len(parts), 6)}"]
    names += [f"mark{m}" for m in ("@", "://", "/", ".", "-", "_", "=", ":", "|", "%", "+") if m in core]
    if re.fullmatch(r"[0-9a-f]+", core):
        names.append(f"hex{min(n // 8, 8)}")
    elif re.fullmatch(r"[0-9a-fA-F]+(?:-[0-9a-fA-F]+)+", core):
        names.append("hexgroups")
    if not core.isascii():
        names.append("wide")
    if _KEYWORD.search(core):
        names.append("keyword")
    if re.search(r"(.)\1\1\1", core):
        names.append("repeats")
    return names


def neighbour_names(token: str) -> list[str]:
    """The features that a token gives to the one before or behind it."""
    names = [f"keyword{bool(_KEYWORD.search(token))}", f"ends{token[-1:] if token[-1:] in _ENDS else ''}"]
    return [*names, "digit"] if any(c.isdigit() for c in token) else names


def shape_features(token: str) -> tuple[int, ...]:
    return tuple(_place(f"own:{x}") for x in shape_names(token))


def neighbour_features(token: str, side: str) -> tuple[int, ...]:
    return tuple(_place(f"{side}:{x}") for x in neighbour_names(token))


def file_features(keyword: bool, n_candidates: int) -> tuple[int, ...]:
    return _place(f"file:keyword{keyword}"), _place(f"file:many{min(n_candidates, MANY - 1)}")


def asks(token: str) -> bool:
    """Whether a word of a token announces a secret behind it."""
    return _ASKING.search(token.translate(_ASCII_LOWER)) is not None


def look(token: str) -> int:
    """What a token is made of, as a place in LOOKS."""
    core = token.strip(_EDGE)
    if core.isalpha():
        kind = "word" if core[1:].islower() or len(core) == 1 else "caps" if core.isupper() else "mixed"
    elif core.isdigit():
        kind = "digits"
    elif core.isalnum():
        kind = "alnum"
    else:
        kind = "marked" if any(c.isalnum() for c in core) else "other"
    return LOOKS.index(kind)


def length(token: str) -> int:
    return min(len(token.strip(_EDGE)) // 4, LENGTHS - 1)


def distances(asking: list[bool]) -> list[int]:
    """Tokens back to the nearest that asks; 0 if none is within REACH."""
    return [next((d for d in range(1, REACH + 1) if d <= i and asking[i - d]), 0) for i in range(len(asking))]


def asked_features(distance: int, of: int, size: int) -> tuple[int, ...]:
    near = min(distance, 1)
    return _place(f"asked:{distance}"), _place(f"asked:{near}:{LOOKS[of]}"), _place(f"asked:{near}:{LOOKS[of]}:{size}")


@dataclass
class Field:
    """emission[place, tag] and transition[from, to] weights; chains begin and end outside."""

    emission: np.ndarray
    transition: np.ndarray

    def scores(self, rows: list[tuple[int, ...]]) -> np.ndarray:
        return np.array([self.emission[list(r)].sum(axis=0) for r in rows])

    def viterbi(self, scores: np.ndarray) -> np.ndarray:
        """The best tags of chains of one length, (chains, tokens, tags) or a single one, whose
        neighbours on both sides are outside."""
        if scores.ndim == 2:
            return self.viterbi(scores[None])[0]
        best, back = self.transition[OUT] + scores[:, 0], []
        for i in range(1, scores.shape[1]):
            through = best[:, :, None] + self.transition
            back.append(through.argmax(axis=1))
            best = through.max(axis=1) + scores[:, i]
        tags = [(best + self.transition[:, OUT]).argmax(axis=1)]
        for b in reversed(back):
            tags.append(np.take_along_axis(b, tags[-1][:, None], 1)[:, 0])
        return np.stack(tags[::-1], axis=1)

    def gradient(self, rows: list[tuple[int, ...]], tags: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Observed less expected: (token, tag) and (from, to) counts, by forward and backward sums."""
        s, t = self.scores(rows), self.transition
        n = len(rows)
        add = np.logaddexp.reduce
        forward, backward = np.zeros((n, 3)), np.zeros((n, 3))
        forward[0], backward[-1] = t[OUT] + s[0], t[:, OUT]
        for i in range(1, n):
            forward[i] = add(forward[i - 1][:, None] + t, axis=0) + s[i]
            backward[-1 - i] = add(t + (s[n - i] + backward[n - i])[None, :], axis=1)
        total = add(forward[-1] + t[:, OUT])
        node = -np.exp(forward + backward - total)
        edge = np.zeros((3, 3))
        for i in range(1, n):
            edge -= np.exp(forward[i - 1][:, None] + t + (s[i] + backward[i])[None, :] - total)
        edge[OUT] += node[0]
        edge[:, OUT] += node[-1]
        for i, tag in enumerate(tags):
            node[i, tag] += 1
        for a, b in zip([OUT, *tags], [*tags, OUT], strict=True):
            edge[a, b] += 1
        return node, edge


def _training_chains(n: int, seed: int) -> Iterator[tuple[list[tuple[int, ...]], list[int]]]:
    """Made-up lines with and without secrets; nothing of a corpus and no vendor's format is in them."""
    rng = random.Random(seed)
    pick = rng.choice
    lower, upper, numerals = string.ascii_lowercase, string.ascii_uppercase, string.digits
    letters, base62, hexes = string.ascii_letters, string.ascii_letters + string.digits, "0123456789abcdef"
    some = lambda chars, low, high: "".join(pick(chars) for _ in range(rng.randint(low, high)))
    digits = lambda low, high: some(numerals, low, high)
    # what gives itself away: long runs of mixed characters, with or without some prefix
    secrets = [
        lambda: some(lower, 2, 6) + pick("_-") + some(base62, 18, 48), lambda: some(lower, 2, 5) + pick("_-") + some(lower, 3, 5) + pick("_-") + some(base62, 16, 40), lambda: some(base62 + "+/", 32, 64) + pick(["", "=", "=="]),
        lambda: some(base62, 16, 40) + "." + some(base62 + "_-", 20, 60) + pick(["", "." + some(base62 + "_-", 24, 43)]), lambda: some(base62, 24, 44) + digits(1, 4), lambda: some(upper, 2, 4) + some(upper + numerals, 16, 20), lambda: some(letters, 2, 4) + some(base62 + "_-", 30, 40),
    ]
    # what is one only if a word announces it
    uuid = lambda: "-".join(some(hexes, k, k) for k in (8, 4, 4, 4, 12))
    weak = [
        lambda: some(letters, 10, 20), lambda: some(letters, 4, 7).capitalize() + pick("$%&#!+*@") + some(letters, 3, 7) + pick(["", "!", "$", "%"]), lambda: digits(4, 12), lambda: some(lower, 4, 7) + digits(1, 4), lambda: some(base62, 6, 16) + pick("$%&#!") + digits(1, 2),
        lambda: some(upper + numerals, 8, 14), lambda: pick(letters) + some(base62, 4, 8) + pick(upper) + digits(1, 2) + pick(lower), lambda: some(lower, 1, 3) + pick("@$0") + some(lower, 2, 4) + digits(0, 2) + some(lower, 1, 3) + pick("!?#%$") + pick(["", "1"]), lambda: some(lower, 16, 32), lambda: "-".join(some(lower, 4, 7) for _ in range(rng.randint(3, 5))),
        lambda: some(hexes, 16, 64), uuid,
    ]
    others = [
        lambda: f"{some(lower, 3, 9)}.{digits(1, 2)}@mail{digits(1, 1)}.example.com", lambda: f"{some(lower, 2, 8)}@{some(lower, 3, 9)}.org", lambda: f"https://{some(lower, 4, 12)}.org/{some(lower, 3, 9)}/{digits(1, 5)}", lambda: f"www.{some(lower, 4, 12)}.com/{some(lower, 2, 8)}-{some(lower, 2, 8)}?id={digits(1, 6)}", lambda: digits(12, 19), lambda: f"{digits(3, 3)}-{digits(4, 4)}",
        lambda: f"+{digits(2, 2)}-{digits(2, 4)}-{digits(5, 8)}", lambda: f"{digits(4, 4)}-{digits(2, 2)}-{digits(2, 2)}T{digits(2, 2)}:{digits(2, 2)}", lambda: f"{digits(4, 4)}/{digits(2, 2)}/{digits(2, 2)}", lambda: f"v{digits(1, 1)}.{digits(1, 2)}.{digits(1, 2)}-beta{digits(1, 1)}", lambda: some(lower, 24, 48), lambda: some(lower, 6, 14) + digits(1, 3),
        lambda: f"/usr/{some(lower, 3, 9)}/{some(lower, 3, 9)}{digits(1, 2)}.txt", lambda: f"{some(lower, 2, 8)}/{some(lower, 2, 8)}_{digits(1, 4)}.{pick(['py', 'csv', 'html'])}", lambda: f"{some(lower, 2, 6)}_{some(lower, 2, 6)}_{digits(1, 3)}", lambda: "_".join(some(lower, 3, 9) for _ in range(rng.randint(2, 6))), lambda: f"IBAN{digits(10, 20)}", lambda: pick(["DE", "FR", "GB"]) + digits(18, 22), lambda: f"{digits(1, 3)}.{digits(1, 3)}.{digits(1, 3)}.{digits(1, 3)}:{digits(2, 4)}",
        lambda: "-".join(some(lower, 3, 10) for _ in range(rng.randint(3, 8))), lambda: pick("=-_*#.") * rng.randint(24, 60), lambda: some(upper, 2, 4) + "-" + digits(3, 6), lambda: some(letters, 24, 30).capitalize(), lambda: f"isbn{digits(13, 13)}", uuid, uuid, lambda: some(hexes, 40, 40), lambda: some(hexes, 7, 12), lambda: some(hexes, 64, 64),
        lambda: some(lower, 3, 7) + "".join(some(lower, 3, 8).capitalize() for _ in range(rng.randint(1, 4))), lambda: f"{some(lower, 2, 8)}({some(lower, 1, 6)},{digits(1, 2)})", lambda: f"{digits(1, 3)}{pick(['px', 'kg', 'mm', 'GB', 'th'])}", lambda: "".join(pick(lower) * rng.randint(2, 6) for _ in range(8)), lambda: some("абвгдежзиклмнопрст", 10, 40), lambda: some("漢字仮名交文日本語学", 4, 40),
    ]
    word = lambda: some(lower + "éèñü", 1, 12)
    words = [
        word, word, word, lambda: word().capitalize(), lambda: word() + pick(",.;:!?"), lambda: f"({word()})", lambda: word().upper(), lambda: digits(1, 12), lambda: digits(1, 4) + pick(",.:%"), lambda: f"{word()}-{word()}",
        lambda: f"{word()}'{pick('std')}", lambda: f"{word()}/{word()}", lambda: word() + pick(["", ".", ","]) + pick(["###", "$$$", "%%%", "&&&", "***"]), lambda: word().capitalize() + pick(["", ".", ","]) + pick("#$%&*!+") * rng.randint(1, 3), lambda: pick("=-+*|#&$") * rng.randint(1, 5), lambda: word().capitalize() + word().capitalize(), lambda: f"{word()}_{word()}",
    ]
    plain = ["see", "the", "for", "number", "call", "is", "in", "of", "file", "version", "page", "mail", "on", "and", "code", "author", "keyboard", "passage", "commit", "id", "request", "revision"]
    asked = ["password:", "password is", "secret key is", "pin", "pin is", "PIN:", "passphrase:", "passphrase is", "token =", "token", "api key:", "key is", "pwd", "credentials:", "my password was", "login:", "bearer", "secret:", "Password", "key ="]
    leads = [*asked, "secret=", "Authorization:", "use", "with", "export", "=", "AWS", "credentials"]
    idle = ["the password", "a token of", "secret", "key to", "the key", "login", "password is required", "pin the", "token", "authorization", "passwords are", "key number", "the token is", "password:", "secret is", "the pin is"]
    for _ in range(n):
        sort = rng.random()
        some_words = lambda low, high: [pick(plain) if rng.random() < 0.3 else pick(words)() for _ in range(rng.randint(low, high))]
        if sort < 0.25:  # what gives itself away, with or without a word that announces it
            middle, lead = [pick(secrets)()], pick(leads if rng.random() < 0.6 else plain)
        elif sort < 0.5:  # others, only behind such a word
            middle, lead = [pick(weak)()], pick(asked)
        elif sort < 0.78:
            middle, lead = [pick(others if rng.random() < 0.6 else weak)()], pick(plain) if rng.random() < 0.8 else ""
        else:  # such words with nothing behind them but text
            middle, lead = [], pick(idle)
        hot = sort < 0.5
        if middle:
            middle[0] = pick(["", "", "", '"', "("]) + middle[0] + pick(["", "", "", ",", ".", '"'])
            if rng.random() < 0.15:  # a second one side by side; secrets go on in it
                middle.append(pick((secrets if sort < 0.25 else weak) if hot else others)())
        head = [*some_words(0, 4), *lead.split()]
        if not middle:  # plain words, none of them like a password
            middle = [pick(plain) if rng.random() < 0.5 else pick(words[:6])() for _ in range(2)]
        tail = some_words(1, 6)
        tags = [OUT] * len(head) + ([BEGIN] + [IN] * (len(middle) - 1) if hot else [OUT] * len(middle)) + [OUT] * len(tail)
        yield text_rows([*head, *middle, *tail], pick([None, None, 2, 3, 6])), tags


def text_rows(tokens: list[str], many: int | None = None) -> list[tuple[int, ...]]:
    """Feature places of each token of a text."""
    around = ["", *tokens, ""]
    n = sum(_CANDIDATE.match(t) is not None for t in tokens)
    file = file_features(any(_KEYWORD.search(t) for t in tokens), n if many is None else many)
    far = distances([asks(t) for t in tokens])
    return [shape_features(t) + neighbour_features(around[i], "before") + neighbour_features(around[i + 2], "behind") + asked_features(far[i], look(t), length(t)) + file for i, t in enumerate(tokens)]


@lru_cache(maxsize=2)
def trained_field(n: int = 3000, epochs: int = 4, seed: int = 11) -> Field:
    """A field fitted by stochastic gradients with per-weight rates on made-up lines."""
    field = Field(np.zeros((PLACES, 3)), np.zeros((3, 3)))
    field.transition[OUT, IN] = -4.0
    seen_e, seen_t = np.full((PLACES, 3), 1e-6), np.full((3, 3), 1e-6)
    chains = list(_training_chains(n, seed))
    order = random.Random(seed)
    for _ in range(epochs):
        order.shuffle(chains)
        for rows, tags in chains:
            node, edge = field.gradient(rows, tags)
            for r, g in zip(rows, node, strict=True):
                at = list(set(r))
                g = g - 1e-3 * field.emission[at]
                seen_e[at] += g * g
                field.emission[at] += 0.3 * g / np.sqrt(seen_e[at])
            edge -= 1e-3 * field.transition
            seen_t += edge * edge
            field.transition += 0.3 * edge / np.sqrt(seen_t)
    return field


@lru_cache(maxsize=1)
def _letter_classes() -> np.ndarray:
    """By code point: 1 lower-case letter, 2 upper-case letter, 3 edge mark, 0 anything else."""
    out = np.zeros(0x10000, np.uint8)
    for i in range(0x10000):
        c = chr(i)
        out[i] = 1 if c.isalpha() and c.islower() else 2 if c.isalpha() and c.isupper() else 3 if c in _EDGE else 0
    return out


class Scanner:
    """Decodes the texts of a slice together; each text's tokens are one chain.

    Plain words are scored by tables over what their features are made of, other tokens one by
    one, and these are remembered up to a bound of characters.
    """

    KEEP_CHARS, BLOCK = 2_000_000, 100_000

    def __init__(self, field: Field):
        self.field = field
        total = lru_cache(maxsize=20_000)(lambda places: field.emission[list(places)].sum(axis=0))
        self.total = total
        self.known: dict[str, np.ndarray] = {}
        self.chars = 0
        own = lambda *names: total(tuple(_place(f"own:{x}") for x in names))
        side = lambda s, *names: total(tuple(_place(f"{s}:{x}") for x in names))
        word = ("keyword",)
        # by length, case (0 lower, 1 capital, 2 capitals) and keyword; by keyword and end
        self.plain_own = np.array([[[own(f"n{n}", f"plain{c > 0}{c > 1}", *word[: int(k)]) for k in (False, True)] for c in range(3)] for n in range(LONG_TOKEN // 4)])
        self.plain_side = {s: np.array([[side(s, f"keyword{k}", f"ends{e}") for e in ["", *_ENDS]] for k in (False, True)]) for s in ("before", "behind")}
        self.edge = {s: total(neighbour_features("", s)) for s in ("before", "behind")}
        self.asked = np.array([[[total(asked_features(d, x, n)) for n in range(LENGTHS)] for x in range(len(LOOKS))] for d in range(REACH + 1)])
        self.file = np.array([[total(file_features(k, n)) for n in range(MANY)] for k in (False, True)])
        t = field.transition
        # the lead of OUT over each tag that no neighbours' tags can turn: before, and behind if
        # that isn't IN; if it is, OUT can have BEGIN behind it in place of IN
        self.lead = (t - t[:, [OUT]]).max(axis=0) + (t - t[[OUT]])[:, :IN].max(axis=1)
        self.lead_in = (t - t[:, [OUT]]).max(axis=0) + t[:, IN] - t[OUT, BEGIN] - (t[BEGIN] - t[IN]).min()

    def _other(self, token: str) -> np.ndarray:
        """Own scores, those for the next token, those for the one before, look and length."""
        found = self.known.get(token)
        if found is None:
            found = np.concatenate([self.total(shape_features(token)), self.total(neighbour_features(token, "before")), self.total(neighbour_features(token, "behind")), [look(token), length(token)]])
            if self.chars > self.KEEP_CHARS:
                self.known, self.chars = {}, 0
            self.known[token] = found
            self.chars += len(token) + 64
        return found

    def _scored(self, tokens: pa.StringArray) -> tuple[np.ndarray, ...]:
        """For different tokens: the scores (n, 9), look, length, and asks, candidate and keyword."""
        n = len(tokens)
        lower = pc.ascii_lower(tokens)
        holds_ = lambda pattern: np.asarray(pc.match_substring_regex(lower, pattern).to_numpy(zero_copy_only=False))
        keyword, asking = holds_(_KEYWORDS), holds_(_ASK)
        size = np.asarray(pc.utf8_length(tokens)).astype(np.int64)
        candidate = (holds_("[0-9]") & holds_("[a-z]") & (size >= 8)) | (size >= LONG_TOKEN)

        codes = np.frombuffer("".join(tokens.to_pylist()).encode("utf-32-le", "surrogatepass"), np.uint32)
        ends = np.cumsum(size)
        begins = ends - size
        kinds = np.where(codes > 0xFFFF, 0, _letter_classes()[np.minimum(codes, 0xFFFF)])
        # the core: from the first to the last character that is no edge mark
        place = np.arange(len(codes))
        first = np.minimum.reduceat(np.where(kinds == 3, len(codes), place), begins)
        last = np.maximum.reduceat(np.where(kinds == 3, -1, place), begins)
        core = last - first + 1
        count = lambda k: np.concatenate([[0], np.cumsum(kinds == k)])
        lows, caps = count(1), count(2)
        ok = (core >= 2) & (core < LONG_TOKEN)
        at, to = np.where(ok, first, 0), np.where(ok, last + 1, 0)
        n_low, n_cap = lows[to] - lows[at], caps[to] - caps[at]
        big = kinds[np.minimum(at, len(codes) - 1)] == 2
        word = ok & ((n_low == core) | (big & (n_low == core - 1)))
        shout = ok & (n_cap == core)
        plain = word | shout
        case = np.where(shout, 2, big.astype(np.int64))
        end = np.zeros(n, np.int64)
        for i, e in enumerate(_ENDS, 1):
            end[codes[ends - 1] == ord(e)] = i
        k = keyword.astype(np.int64)
        scores = np.zeros((n, 9))
        size_class = np.where(plain, core // 4, 0)
        scores[:, :3] = self.plain_own[size_class, case, k]
        scores[:, 3:6], scores[:, 6:] = self.plain_side["before"][k, end], self.plain_side["behind"][k, end]
        kind = np.where(shout, LOOKS.index("caps"), LOOKS.index("word"))
        long = np.minimum(size_class, LENGTHS - 1)
        rest = np.flatnonzero(~plain)
        if len(rest):
            found = np.stack([self._other(t) for t in tokens.take(pa.array(rest)).to_pylist()])
            scores[rest], kind[rest], long[rest] = found[:, :9], found[:, 9], found[:, 10]
        return scores, kind, long, asking, candidate, keyword

    def tags(self, tokens: pa.StringArray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and tags of the tokens that the best chains tag, for texts from offset to offset.

        Chains are cut only at tokens that are OUT in the best one whatever stands beside them,
        so cutting changes nothing.
        """
        if not len(tokens):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        coded = tokens.dictionary_encode()
        ids = coded.indices.to_numpy()
        scores, look_, long, asking, candidate, keyword = self._scored(coded.dictionary)
        text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        in_text = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag[ids], dtype=np.int32)])[offsets])
        file = self.file[(in_text(keyword) > 0).astype(np.int64), np.minimum(in_text(candidate), MANY - 1)]
        asked = asking[ids]
        far = np.zeros(len(ids), np.int8)
        for d in range(min(REACH, len(ids) - 1), 0, -1):
            far[d:][asked[:-d] & (text[d:] == text[:-d])] = d

        def of(low: int, high: int) -> np.ndarray:
            """The scores of some tokens, of which only a block is held at once."""
            mine = ids[low:high]
            s = scores[mine, :3] + self.asked[far[low:high], look_[mine], long[mine]] + file[text[low:high]]
            around = np.concatenate([text[max(low - 1, 0) : low], text[low:high], text[high : high + 1]])
            same = around[1:] == around[:-1]
            before, behind = scores[ids[max(low - 1, 0) : high - 1], 3:6], scores[ids[low + 1 : high + 1], 6:]
            if low == 0:
                before, same = np.concatenate([np.zeros((1, 3)), before]), np.concatenate([[False], same])
            if high == len(ids):
                behind, same = np.concatenate([behind, np.zeros((1, 3))]), np.concatenate([same, [False]])
            s += np.where(same[:-1, None], before, self.edge["before"])
            return s + np.where(same[1:, None], behind, self.edge["behind"])

        places, kept = [], []
        for low in range(0, len(ids), self.BLOCK):
            high = min(low + self.BLOCK, len(ids))
            s = of(low, min(high + 1, len(ids)))
            lead = np.tile(self.lead, (len(s), 1))
            lead[:-1] = np.maximum(lead[:-1], self.lead_in + (s[1:, IN] - s[1:, BEGIN])[:, None])
            at = np.flatnonzero((s[:, [OUT]] - s <= lead)[: high - low, BEGIN:].any(axis=1))
            places.append(at + low)
            kept.append(s[at])
        open_at, s = np.concatenate(places), np.concatenate(kept)
        if not len(open_at):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        begins = np.flatnonzero(np.concatenate([[True], (np.diff(open_at) > 1) | (text[open_at[1:]] != text[open_at[:-1]])]))
        sizes = np.diff(np.append(begins, len(open_at)))
        found = np.zeros(len(open_at), np.int64)
        for size in np.unique(sizes).tolist():
            rows = begins[sizes == size][:, None] + np.arange(size)
            found[rows] = self.field.viterbi(s[rows])
        return open_at[found > 0], found[found > 0]


_scanner: Scanner | None = None


def _scanner_of(field: Field) -> Scanner:
    """This worker's scanner, a new one for another field."""
    global _scanner
    if _scanner is None or _scanner.field is not field:
        _scanner = Scanner(field)
    return _scanner


def _located(tokens: list[str], text: str, wanted: Iterable[int]) -> dict[int, tuple[int, int]]:
    """Where some of a text's tokens stand; between them is only white space."""
    out, at, wanted = {}, 0, set(wanted)
    last = max(wanted)
    for i, token in enumerate(tokens[: last + 1]):
        at = text.index(token, at)
        if i in wanted:
            out[i] = (at, at + len(token))
        at += len(token)
    return out


def field_spans(texts: list[str], field: Field) -> list[list[tuple[int, int, str]]]:
    """Spans that the field tags in each text."""
    split = pc.utf8_split_whitespace(pa.array(texts, pa.string()))
    # texts with white space at their ends have empty pieces there
    pieces, parent = split.flatten(), pc.list_parent_indices(split)
    kept = pc.greater(pc.binary_length(pieces), 0)
    pieces, parent = pieces.filter(kept), np.asarray(parent.filter(kept))
    offsets = np.searchsorted(parent, np.arange(len(texts) + 1))
    places, tags = _scanner_of(field).tags(pieces, offsets)
    out: list[list[tuple[int, int, str]]] = [[] for _ in texts]
    if not len(places):
        return out
    owner = parent[places]
    edges = np.flatnonzero(np.diff(owner, prepend=-1, append=-1)).tolist()
    for low, high in itertools.pairwise(edges):
        number = int(owner[low])
        base, text = int(offsets[number]), texts[number]
        mine = (places[low:high] - base).tolist()
        where = _located(pieces.slice(base, mine[-1] + 1).to_pylist(), text, mine)
        runs: list[list[int]] = []
        for i, tag in zip(mine, tags[low:high].tolist(), strict=True):
            if tag == IN and runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        for first, last in runs:
            start, end = where[first][0], where[last][1]
            raw = text[start:end]
            start, end = start + len(raw) - len(raw.lstrip(_EDGE)), end - (len(raw) - len(raw.rstrip(_EDGE)))
            if end > start:
                out[number].append((start, end, "crf"))
    return out


def _adding(text: str, spans: list[tuple[int, int, str]], base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The spans, in order and apart, that hold more than marks and white space outside the rules'."""
    bare = lambda a, b: not text[a:b].strip().strip(_EDGE).strip()
    out, first = [], 0
    for span in spans:
        at, end, _ = span
        while first < len(base) and base[first][1] <= at:  # rules' spans of one kind are apart; few kinds
            first += 1
        adds, i = False, first
        while i < len(base) and base[i][0] < end and not adds:
            adds = base[i][0] > at and not bare(at, base[i][0])
            at = max(at, base[i][1])
            i += 1
        if adds or (at < end and not bare(at, end)):
            out.append(span)
    return out


def all_spans(texts: list[str], field: Field) -> list[tuple[list, list]]:
    """For each text the rules' spans, and those with the field's that cover what the rules don't."""
    out = []
    for text, found in zip(texts, field_spans(texts, field), strict=True):
        base = base_spans(text)
        out.append((base, sorted([*base, *_adding(text, found, base)], key=lambda s: (s[0], KINDS.index(s[2])))))
    return out


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span, overlapping ones together, replaced by a mark."""
    out, at = [], 0
    for start, end, _ in sorted(spans):
        if start >= at:
            out += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*out, text[at:]])


def _forget() -> None:
    global _scanner
    _scanner = None


def secret_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_field, base_sha256 and spans for every row.

    Null and empty texts have no spans. Ids, null or repeated, pass through; an empty table
    gives no rows; other columns are ignored.
    """
    field = docs.sparkSession.sparkContext.broadcast(trained_field())

    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("secrets", _forget)
        for batch in slices(batches, 1):
            rows = []
            for base, spans in all_spans(texts_of(batch, 1), field.value):
                kinds = [s[2] for s in base]
                rows.append((kinds.count("assign"), kinds.count("access"), kinds.count("hex"), len(spans) - len(base), hashlib.sha256(joined(base).encode()).hexdigest(), joined(spans)))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.int64()] * 4 + [pa.string()] * 2, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_assign", "n_access", "n_hex", "n_field", "base_sha256", "spans"])

    plain = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(scan, "doc_id long, n_assign long, n_access long, n_hex long, n_field long, base_sha256 string, spans string")


def redacted_documents(docs: DataFrame, *, text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """All rows and columns with secrets replaced in the text, and its length updated if it's kept."""
    field = docs.sparkSession.sparkContext.broadcast(trained_field())

    def clean(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        holds("secrets", _forget)
        for batch in slices(batches, 0):
            given = batch.column(0).to_pylist()
            texts = [t if t is None else redact(t, spans) for t, (_, spans) in zip(given, all_spans(texts_of(batch, 0), field.value), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), batch.column(1)], names=["_text", "_row"])

    given = docs.select(F.col(text_col).alias("_text"), F.struct(*(f"`{c}`" for c in docs.columns if c != text_col)).alias("_row"))
    done = given.mapInArrow(clean, T.StructType([T.StructField("_text", T.StringType()), given.schema["_row"]]))
    changed = {text_col: F.col("_text"), chars_col: F.char_length("_text").cast("long")}
    return done.select(*(changed.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))
