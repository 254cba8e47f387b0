"""Secret scans: base patterns, and novelty under a primed zstandard compressor.

Base spans come from three patterns over the whole text. The method adds spans: a long string that stands behind a
sensitive word, or inside code, is a candidate. Its context is sensitive if such a word stands just before it or before it
in its sentence, if it lies in a private key block, if it is a quoted value of code, or if the candidate right before it, in its line
or the line above, has such a context: a key may be wrapped over lines. Its novelty is its marginal compressed size: how many more bytes a
zstandard frame takes with the candidate than without, where the compressor is primed with a dictionary of identifiers and
the frame holds the text around the candidate. A word, an identifier or anything the surroundings repeat adds a few
bytes; a random key is incompressible and adds nearly its entropy. What entropy that is depends on the candidate's alphabet,
its length and how the frame codes literals, so it is measured: random characters of the same alphabet are put in the
candidate's place. Candidates in a sensitive context that take at least the share `AS_RANDOM` of their bytes
(`AS_RANDOM_LONG` beyond `LONG` characters) are reported; those of letters alone must also be unlike words in their pairs of letters. The short last line of a wrapped key goes with it.
Besides strings of twenty and more letters, digits and the characters of base64, a candidate may be shorter (from twelve on) or hold any
mark that passwords have; such ones must mix upper and lower case, digits or marks as random strings do, and need a sensitive word of their own.
Sensitive words are whole words: parted from others by anything but a letter, or by a change of case as in `apiKey`, or joined to
another sensitive word; the long ones may also end a longer word. Inside a URL only words of that URL count, and strings that are
labelled as checksums are none.
Each distinct candidate of a text is judged once, short ones first, in surroundings from which its other occurrences and the keys
found so far are taken out.

Spans are code points, end exclusive. Null and empty texts have none. Equal texts have equal spans.
"""

from __future__ import annotations

import math
import random
import re
import string
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame

from tillwise.llm.common import with_results

# Fixed values of the base patterns; letters of the words may be in either case, ASCII only.
WORDS = ("password", "passwd", "secret", "token", "api_?key")
KINDS = ("assign", "access", "hex", "novel")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 12, 18, 16


def any_case(word: str) -> str:
    return "".join(f"[{x.upper()}{x}]" if x.isalpha() else x for x in word)


ASSIGN = re.compile(rf"(?:{'|'.join(map(any_case, WORDS))})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ASSIGN_HINT = re.compile("|".join(map(any_case, ("passw", "secret", "token", "api"))))
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the longest runs of at least so many

# The method's own words and bounds.
SENSITIVE = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "credential", "authorization", "bearer", "private", "access", "signature", "auth", "key")
CONTEXT = re.compile(f"(?:{'|'.join(map(any_case, SENSITIVE))})[sS]?")
#: Words that are sensitive also at the end of a longer word, as in `dbpassword`.
ENDINGS = ("password", "passwd", "secret", "token", "credential", "api_key", "apikey")
URL = re.compile(r"://[^\s\"'`<>]+")
CHECKSUM = re.compile(r"(?i:integrity|checksum|digest|etag|sha-?[0-9]{1,3}|md5)[\"']?\s{0,4}[=:]\s{0,4}[\"'`]?\Z")
HASHED = re.compile(r"sha[0-9]{1,3}[-=]")
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
#: Shorter ones with a digit, and ones with marks of passwords, which end at white space, quotes or punctuation.
SHORT = re.compile(r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]{0,18}[0-9])[A-Za-z0-9+/_=-]{12,19}(?![A-Za-z0-9+/_=-])")
MARKS = "!#$%&*?@^~|"
MARKED = re.compile(rf"(?<![^\s\"'`=:(])(?=[A-Za-z0-9+./:=_-]{{0,64}}[{re.escape(MARKS)}])[A-Za-z0-9+./:=_{re.escape(MARKS)}-]{{12,}}(?=[\s\"'`,;)]|\Z)")
#: Of the neighbouring characters of a random string, nearly two thirds differ in kind.
MIXED = 0.4
BEFORE, AROUND = 48, 256
SENTENCE_END = re.compile(r"[.!?]\s|\n")
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----")
#: A quoted value in code: assigned, an entry, an argument or an element.
IN_CODE = re.compile(r"[=:(\[{,]\s{0,8}[A-Za-z]{0,2}([\"'`])\Z")
#: What may stand around the lines of a wrapped key, the step to the next line, and a short last line.
MARGIN = r"(?:\\r|[^\S\n]|[\"'`+,;\\>#*|.])"
NEXT_LINE = re.compile(rf"{MARGIN}*?(?:\n|\\n){MARGIN}*+")
LAST_LINE = re.compile(rf"{NEXT_LINE.pattern}([A-Za-z0-9+/][A-Za-z0-9+/_-]{{0,18}}=*)(?={MARGIN}*(?:\n|\\n|\Z|-----END))")
#: Short strings are stored byte by byte, so that a chance match shows; in long ones it does not.
AS_RANDOM, AS_RANDOM_LONG, LONG = 0.8, 0.9, 64
#: Random strings differ among themselves, in long ones of small alphabets by more than that; the cheapest of so many counts.
DRAWS = 3
#: From small to large; a candidate has the first that holds all its characters, separators left aside.
ALPHABETS = (
    string.digits, "0123456789ABCDEF", "0123456789abcdef", string.ascii_uppercase, string.ascii_lowercase,
    string.ascii_uppercase + "234567", string.ascii_lowercase + "234567", string.ascii_uppercase + string.digits,
    string.ascii_lowercase + string.digits, string.ascii_letters, string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/",
    string.ascii_letters + string.digits + string.punctuation,
)
SEPARATORS = frozenset("_-=")
#: The parts of a name; the bits that a letter behind another one of its word may take on average.
PARTS = re.compile("[A-Z]?[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]")
VOWELS = frozenset("aeiouy")
NAME_BITS = 5.1
#: Identifiers and words that code and settings are full of; they prime the compressor.
IDENTIFIERS = (
    "import from return class def function const let var public private static void string integer boolean number object "
    "array length index value default name type config settings environment variable example placeholder changeme your "
    "password passwd secret token api_key apikey access_key client_id client_secret authorization bearer credential session "
    "user username email account admin database connection host port localhost http https www com org net url path file "
    "directory response request header content application json xml html version release build package module library "
    "abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef xxxxxxxxxxxxxxxxxxxxxxxx 0000000000000000 "
    "getElementById addEventListener createElement toString parseInt isEmpty hasNext iterator container component "
    "the and for that with this from have are not was you but all can had her one our out day get has him his how man new now "
)


@lru_cache(maxsize=1)
def compressor():
    import zstandard

    primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(level=12, dict_data=primed, write_content_size=False)


def random_like(candidate: str) -> list[str]:
    """`DRAWS` strings of random characters of the candidate's alphabet, separators where it has them; the same for equal ones."""
    own = set(candidate) - SEPARATORS
    alphabet = next(x for x in ALPHABETS if own <= set(x))
    source = random.Random(candidate)
    drawn = (source.choices(alphabet, k=len(candidate)) for _ in range(DRAWS))
    return ["".join(x if x in SEPARATORS else y for x, y in zip(candidate, one, strict=True)) for one in drawn]


@lru_cache(maxsize=1)
def letter_pairs() -> dict[str, float]:
    """Bits of a letter behind another one, in the identifiers."""
    pairs = Counter(x + y for word in re.findall("[a-z]+", IDENTIFIERS.lower()) if len(set(word)) > 1 and word not in string.ascii_lowercase for x, y in zip(word, word[1:]))
    firsts = Counter(x[0] for x in pairs.elements())
    return {x + y: -math.log2((pairs[x + y] + 0.2) / (firsts[x] + 0.2 * 26)) for x in string.ascii_lowercase for y in string.ascii_lowercase}


def wordlike(candidate: str) -> bool:
    """Whether the pairs of letters are likelier in identifiers than among letters that are all equally likely."""
    letters = candidate.lower()
    bits = [letter_pairs()[x + y] for x, y in zip(letters, letters[1:]) if x.isalpha() and y.isalpha()]
    return sum(bits) < math.log2(26) * len(bits)


def identifier(candidate: str) -> bool:
    """Whether it is a name: words that can be spoken, parted by case or separators, and at most two numbers."""
    parts = PARTS.findall(candidate)
    words = [x.lower() for x in parts if x[0].isalpha()]
    numbers = sum(x[0].isdigit() for x in parts)
    if numbers > 2 or len(words) + numbers < 2 or sum(map(len, words)) < 3 * len(words) or not words:
        return False
    if any(len(x) >= 3 and not VOWELS & set(x) for x in words):
        return False
    bits = [letter_pairs()[x + y] for word in words for x, y in zip(word, word[1:])]
    return sum(bits) < NAME_BITS * len(bits)


def around(text: str, start: int, end: int, keys: Iterable[str] = ()) -> tuple[str, str]:
    """The text before and after the candidate, without what repeats it or one of the keys."""
    candidate, length = text[start:end], end - start
    low, high = max(0, start - AROUND - length), min(len(text), end + AROUND + length)
    taken = sorted({candidate, *keys}, key=len, reverse=True)
    for x in taken:  # occurrences across the edges
        if (cut := text.find(x, max(0, low - len(x) + 1), min(start, low + len(x) - 1))) >= 0:
            low = cut + len(x)
        if (cut := text.rfind(x, max(end, high - len(x) + 1), high + len(x) - 1)) >= 0:
            high = cut
    before, after = text[low:start], text[end:high]
    for x in taken:
        before, after = before.replace(x, ""), after.replace(x, "")
    return before[-AROUND:], after[:AROUND]


def is_random(text: str, start: int, end: int, keys: Iterable[str] = ()) -> bool:
    """Whether the candidate adds nearly as many bytes to its surroundings as random characters of its alphabet do."""
    candidate = text[start:end]
    if not any(x.isalnum() for x in candidate) or not any(x.isdigit() for x in candidate) and wordlike(candidate) or identifier(candidate):
        return False
    before, after = around(text, start, end, keys)

    def size(added: str) -> int:
        return len(compressor().compress((before + after + added).encode("utf-8", "replace")))

    without = size("") + 1
    share = AS_RANDOM if end - start <= LONG else AS_RANDOM_LONG
    return size(" " + candidate) - without >= share * (min(size(" " + x) for x in random_like(candidate)) - without)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order."""
    found = []
    if ASSIGN_HINT.search(text):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def key_blocks(text: str) -> list[tuple[int, int]]:
    """(start, end) of private key blocks with an end."""
    found, at = [], 0
    while begin := KEY_BLOCK.search(text, at):
        at = text.find("-----END", begin.end())
        if at < 0:
            break
        found.append((begin.end(), at))
    return found


def place_of(places: list[tuple[int, int]], start: int) -> int:
    i = bisect_right(places, start, key=itemgetter(0)) - 1
    return i if i >= 0 and start < places[i][1] else -1


def context_words(text: str) -> list[int]:
    """Ends of the sensitive words that stand as words."""
    ends, joint = [], -1  # where a sensitive word ended that another one may join
    for m in CONTEXT.finditer(text):
        start, end = m.span()
        before, after = text[start - 1 : start], text[end : end + 1]
        begins = not before.isalpha() or text[start].isupper() and before.islower() or start == joint or m.group().lower().rstrip("s") in ENDINGS
        if not begins:
            continue
        joint = end
        if not after.isalpha() or after.isupper() and text[end - 1].islower():
            ends.append(end)
    return ends


def mixed(candidate: str) -> bool:
    """Whether upper and lower case, digits and marks follow each other as in a random string, three of the kinds at least."""
    kinds = ["a" if x.islower() else "A" if x.isupper() else "0" if x.isdigit() else "!" for x in candidate]
    changes = sum(x != y for x, y in zip(kinds, kinds[1:]))
    return len(set(kinds)) >= 3 and changes >= MIXED * (len(kinds) - 1) and not wordlike(candidate) and not identifier(candidate)


def sensitive_candidates(text: str) -> Iterator[tuple[int, int, int]]:
    """(start, end, number of the private key block or -1) of the candidates in a sensitive context."""
    plain = {m.span() for m in CANDIDATE.finditer(text)}
    wild = {m.span() for m in SHORT.finditer(text)}
    if any(x in text for x in MARKS):
        wild |= {m.span() for m in MARKED.finditer(text) if len(set(m.group()) & set(MARKS)) >= 2}
    if not plain and not wild:
        return
    words = context_words(text)
    ends = [m.end() for m in SENTENCE_END.finditer(text)] if words else []
    blocks = key_blocks(text) if words else []
    urls = [m.span() for m in URL.finditer(text)]
    last = None  # end of the candidate before, if its context is sensitive
    for start, end in sorted(plain | wild):
        loose = (start, end) not in plain
        if loose and (not words or not mixed(text[start:end])):
            continue
        if HASHED.match(text, start) or CHECKSUM.search(text, max(0, start - 24), start):
            last = None
            continue
        i, j, url = bisect_right(words, start), bisect_right(ends, start), place_of(urls, start)
        if url >= 0 or loose and "://" in text[start:end]:
            if not loose and i > 0 and words[i - 1] > max(urls[url][0], start - BEFORE):
                yield start, end, -1
            last = None
            continue
        block = place_of(blocks, start)
        sensitive = block >= 0 or i > 0 and words[i - 1] > min(start - BEFORE, ends[j - 1] if j else 0)
        if loose:
            if sensitive and block < 0:
                yield start, end, block
            continue
        if not sensitive and last is not None:
            gap = text[last:start].strip()
            sensitive = len(gap) <= BEFORE and "\n" not in gap
        if not sensitive:
            quote = IN_CODE.search(text, max(0, start - 12), start)
            sensitive = quote is not None and text.startswith(quote.group(1), end)
        last = end if sensitive else None
        if sensitive:
            yield start, end, block


def outermost(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Without those inside another."""
    kept, reach = [], -1
    for span in sorted(spans, key=lambda x: (x[0], -x[2])):
        if span[2] > reach:
            kept.append(span)
            reach = span[2]
    return kept


def novel_spans(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Incompressible strings in a sensitive context that no base span covers to their ends; all lines of key blocks with one."""
    found = []
    candidates = list(sensitive_candidates(text))
    covered = [any((s <= start or kind == 0) and s < end <= e for s, kind, e in base) for start, end, _ in candidates]  # an assignment may begin inside its label
    verdicts: dict[str, bool] = {}
    starts = [start for start, *_ in candidates]
    for i in sorted(range(len(candidates)), key=lambda i: candidates[i][1] - candidates[i][0]):
        start, end, _ = candidates[i]
        if not covered[i] and text[start:end] not in verdicts:
            near = candidates[bisect_left(starts, start - AROUND) : bisect_right(starts, end + AROUND)]
            verdicts[text[start:end]] = is_random(text, start, end, [x for s, e, _ in near if verdicts.get(x := text[s:e])])
    random_ = [not known and verdicts[text[start:end]] for (start, end, _), known in zip(candidates, covered, strict=True)]
    keys = {block for (_, _, block), known, yes in zip(candidates, covered, random_, strict=True) if block >= 0 and (known or yes)}
    above = None  # the line of a key before
    for (start, end, block), known, yes in zip(candidates, covered, random_, strict=True):
        if not (known or yes or block in keys):
            above = None
            continue
        if not known:
            found.append((start, 3, end))
        wrapped = above is not None and above[1] - above[0] == end - start and NEXT_LINE.fullmatch(text, above[1], start)
        if (wrapped or block in keys) and (rest := LAST_LINE.match(text, end)) and rest.end(1) - rest.start(1) < end - start:
            found.append((rest.start(1), 3, rest.end(1)))
        above = start, end
    return outermost(found)


def scan_text(text: str | None) -> list[tuple[int, int, int]]:
    """All spans of a text by start, then kind."""
    if not text:
        return []
    base = base_spans(text)
    return sorted(base + novel_spans(text, base))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the number of base spans by kind, `base_spans` and `spans`, each span as kind:start:end."""

    def run(texts):
        found = [scan_text(x) for x in texts]
        base = [[x for x in spans if x[1] < 3] for spans in found]
        counts = [[sum(x[1] == kind for x in spans) for spans in base] for kind in range(3)]
        return [*counts, [joined(x) for x in base], [joined(x) for x in found]]

    added = {"n_assign": pa.int64(), "n_access": pa.int64(), "n_hex": pa.int64(), "base_spans": pa.string(), "spans": pa.string()}
    return with_results(docs, text, added, run)


def redact_text(text: str | None, mark: str = "[SECRET]") -> str | None:
    """The text with every span, and spans that overlap it, replaced by the mark."""
    spans = scan_text(text)
    if not spans:
        return text
    parts, at = [], 0
    for start, _, end in spans:
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows, in the same columns, with the secrets of their texts replaced; null texts stay null."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    changed = with_results(plain, f"c{names.index(text)}", {"redacted": pa.string()}, lambda texts: [[redact_text(x) for x in texts]])
    kept = [("redacted" if name == text else f"c{i}") for i, name in enumerate(names)]
    return changed.select(*kept).toDF(*names)
