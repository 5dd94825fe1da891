"""Personal data: plain patterns, and spans found after undoing disguises."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lymphlake.llm.common import map_text, pieces, sha256_hex

#: Order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone")
SCHEMA = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local@domain; every @ is looked at once, so that long runs stay linear."""
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        else:
            # a later local part cannot contain this @
            done = at + 1
        at = text.find("@", max(done, at + 1))


def find(text: str) -> list[tuple[int, int, str]]:
    """Plain spans ``(start, end, kind)`` of a text, in code points.

    Per kind the matches are leftmost and do not overlap; one that fails its
    test (parts up to 255, 12 to 19 digits and Luhn, 9 to 15 digits) is
    dropped and its characters are not tried again.
    """
    out = [(s, e, "email") for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            out.append((m.start(), m.end(), "ip"))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append((m.start(), m.end(), "card"))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((m.start(), m.end(), "phone"))
    return out


class Tape:
    """A normalised text together with the stretches of its source that were rewritten.

    Segments alternate between copied and rewritten stretches; odd ones are
    rewritten. ``at`` holds where each begins in ``text``, ``begins`` and
    ``ends`` where it lies in ``source``.
    """

    def __init__(self, source: str, edits: list[tuple[int, int, str]] = ()):
        self.source, self.edits = source, edits
        parts, self.at, self.begins, self.ends = [], [0], [0], []
        pos = length = 0
        for s, e, new in edits:
            for begin, end, piece in ((pos, s, source[pos:s]), (s, e, new)):
                parts.append(piece)
                length += len(piece)
                self.ends.append(end)
                self.begins.append(end)
                self.at.append(length)
            pos = e
        parts.append(source[pos:])
        self.ends.append(len(source))
        self.text = "".join(parts)

    def span(self, s: int, e: int) -> tuple[int, int]:
        """Where a stretch of the text lies in the source; rewritten stretches count whole."""
        i, j = bisect_right(self.at, s) - 1, bisect_right(self.at, e - 1) - 1
        begin = self.begins[i] + (s - self.at[i] if i % 2 == 0 else 0)
        return begin, self.begins[j] + (e - self.at[j]) if j % 2 == 0 else self.ends[j]

    def rewritten(self, s: int, e: int) -> bool:
        """Whether a stretch of the text takes in something that was rewritten."""
        i, j = bisect_right(self.at, s) - 1, bisect_right(self.at, e - 1) - 1
        return i != j or i % 2 == 1

    def then(self, edits: list[tuple[int, int, str]]) -> Tape:
        """The tape behind a further transducer whose edits are in this one's text; they take in the edits they cover."""
        return Tape(self.source, _in_order([*self.edits, *[(*self.span(s, e), new) for s, e, new in edits]])) if edits else self


class Transducer:
    """A deterministic finite-state transducer over code points.

    ``moves[state]`` maps a code point to the next state, what is written, and
    whether a new stretch of the offset tape begins. From a place it reads on
    while there is a move; the last state of ``final`` on the way accepts, and
    what was read up to there is rewritten stretch by stretch. ``final`` says
    whether a letter or digit may follow. ``places`` finds where the start
    state can be left at all.
    """

    def __init__(self, places: str):
        self.places = re.compile(places)
        self.moves: list[dict[str, tuple[int, str, bool]]] = [{}]
        self.final: dict[int, bool] = {}

    def state(self) -> int:
        self.moves.append({})
        return len(self.moves) - 1

    def word(self, start: int, word: str, last: int, written: str, begins: bool) -> None:
        """A path for ``word`` in any case from ``start`` to ``last``; paths share their beginnings."""
        for i, c in enumerate(word):
            first = begins and i == 0
            if i == len(word) - 1:
                target = (last, written, first)
            else:
                target = self.moves[start].get(c) or (self.state(), "", first)
            for x in {c, c.upper()}:
                self.moves[start][x] = target
            start = target[0]

    def read(self, text: str, at: int) -> tuple[int, list[tuple[int, int, str]]] | None:
        """End and edits of the longest accepted stretch from a place."""
        state, begun, written, accepted = 0, [], [], None
        while at < len(text) and (move := self.moves[state].get(text[at])):
            state, out, begins = move
            if begins:
                begun.append(at)
                written.append("")
            written[-1] += out
            at += 1
            free = self.final.get(state)
            if free is not None and (free or at == len(text) or not (text[at].isalnum() or text[at] == "_")):
                accepted = at, len(begun)
        if accepted is None:
            return None
        end, n = accepted
        return end, list(zip(begun[:n], [*begun[1:n], end], written, strict=False))

    def edits(self, text: str) -> list[tuple[int, int, str]]:
        """Edits of all stretches, leftmost first; what is not accepted is copied."""
        out, m = [], self.places.search(text)
        while m:
            found = self.read(text, m.start())
            if found:
                out += found[1]
            m = self.places.search(text, found[0] if found else m.start() + 1)
        return out


# Look-alike letters of other scripts, and names of digits.
HOMOGLYPHS = dict(zip("аАеЕоОрРсСхХуУіІјЈѕЅһԁԛԝВМНКТЗαΑοΟρΡΕΗΙΚΜΝΤΥΧΖΒνᴏ", "aAeEoOpPcCxXyYiIjJsShdqwBMHKT3aAoOpPEHIKMNTYXZBvo", strict=True))
_NAMED_DIGITS = (
    "zero oh one two three four five six seven eight nine",
    "null - eins zwei drei vier fünf sechs sieben acht neun",
    "zéro - un deux trois quatre cinq six sept huit neuf",
    "cero - uno dos tres cuatro cinco seis siete ocho nueve",
)
DIGIT_NAMES = {name: str(max(0, i - 1)) for line in _NAMED_DIGITS for i, name in enumerate(line.split()) if name != "-"}
# Rules instead of tables: full-width ASCII, and the decimal digits of other scripts.
_TRANSLATE = {ord(a): b for a, b in HOMOGLYPHS.items()} | {0xFF00 + i: chr(0x20 + i) for i in range(1, 95)}
_TRANSLATE |= {base + i: str(i) for base in (0x0660, 0x06F0, 0x0966, 0x09E6) for i in range(10)}
_TRANSLATE |= {ord(c): "" for c in "\u200b\u200c\u200d\u2060\ufeff\u00ad"}
_NAME = "|".join(sorted(DIGIT_NAMES, key=len, reverse=True))


def _lookalikes() -> Transducer:
    """One code point for another, or for none."""
    machine = Transducer("[" + "".join(map(chr, _TRANSLATE)) + "]")
    end = machine.state()
    machine.final[end] = True
    machine.moves[0] = {chr(c): (end, new, True) for c, new in _TRANSLATE.items()}
    return machine


def _spelled_digits(least: int = 3) -> Transducer:
    """Runs of digit names, and digits between them, once ``least`` names were read; separators go.

    States count the names up to ``least``; a run starts with a name.
    """
    machine = Transducer(rf"(?i)(?<!\w)(?:{_NAME})[\x20,-]")
    named = [machine.state() for _ in range(least + 1)]  # behind an item, after so many names
    apart = [machine.state() for _ in range(least + 1)]  # behind a separator
    for n in range(least + 1):
        for c in " ,-":
            machine.moves[named[n]][c] = machine.moves[apart[n]][c] = (apart[n], "", False)
        for name, digit in DIGIT_NAMES.items():
            machine.word(apart[n], name, named[min(n + 1, least)], digit, True)
        for d in "0123456789":
            machine.moves[apart[n]][d] = (named[n], d, True)
    for name, digit in DIGIT_NAMES.items():
        machine.word(0, name, named[1], digit, True)
    machine.final[named[least]] = False
    return machine


def _bracketed_signs() -> Transducer:
    """A sign or its name in brackets, with any number of spaces inside and behind."""
    machine = Transducer(r"[\[({<]")
    inside, end = machine.state(), machine.state()
    signs = {"at": "@", "@": "@", "dot": ".", ".": ".", "punkt": ".", "point": ".", "punto": "."}
    behind = {sign: machine.state() for sign in "@."}
    machine.moves[0] = {c: (inside, "", True) for c in "[({<"}
    machine.moves[inside][" "] = (inside, "", False)
    machine.moves[end][" "] = (end, "", False)
    for word, sign in signs.items():
        machine.word(inside, word, behind[sign], sign, False)
    for state in behind.values():
        machine.moves[state] |= {" ": (state, "", False)} | {c: (end, "", False) for c in "])}>"}
    machine.final[end] = True
    return machine


def _dots_between_digits() -> Transducer:
    """`` dot `` behind a digit and before one; the digits are looked at only."""
    machine = Transducer(r"(?i)(?<=[0-9])\x20dot\x20(?=[0-9])")
    end = machine.state()
    machine.final[end] = True
    machine.word(0, " dot ", end, ".", True)
    return machine


LOOKALIKES, SPELLED_DIGITS, BRACKETED_SIGNS, DIGIT_DOTS = _lookalikes(), _spelled_digits(), _bracketed_signs(), _dots_between_digits()
_SIGN = re.compile(r"(?i)@|\x20at\x20")
_WORDED_DOMAIN = re.compile(r"(?i)[a-z0-9-]++(?:(?:\.|\x20dot\x20)[a-z0-9-]++)+")
_WORD_DOT = re.compile(r"(?i)\x20dot\x20")
_SEPARATOR = re.compile(r"(?i)\.|\x20dot\x20")
_END = re.compile(r"(?i)[a-z]{2,24}")
#: A local part that prose does not put before "at": two worded parts, a joint, or a letter with a digit after it.
_ADDRESS_LIKE = re.compile(r"(?i)\x20dot\x20|[a-z0-9][_+%][a-z0-9]|[a-z]{2}\.[a-z]{2}|[a-z][0-9]")
# Fixed values, for "word at word dot end" and "word at host.end" without any other sign of an address, which prose
# can say too: ends that are taken for one (any of two letters besides), and words that prose has before "dot" and "at".
_ENDS = frozenset("com net org edu gov info biz io co eu us uk de fr es it nl ch at ru jp cn in br".split())
_MORE_ENDS = frozenset(
    "academy agency app art bank bio blog business cafe cat center city cloud club codes company consulting design dev digital education email energy expert family "
    "finance fitness foundation fun fund games global group guru health host house inc institute int international jobs law legal life link live llc ltd mail marketing "
    "media mil mobi money museum name network news ngo ninja online page partners photo photography post press pro pub restaurant school science services shop site "
    "social software solutions space store studio systems tax team tech technology tel today tools top training travel university video vip web website wiki work works "
    "world wtf xyz zone aero asia coop travel berlin hamburg koeln london paris tokyo wien zuerich".split()
)
_NO_END = frozenset("an go he if oh ok of on or up we".split())
_PROSE_HOST = frozenset("a an the this that these those my your his her its our their each every any some no one which what home work".split())
_PROSE_LOCAL = frozenset(
    "about account are arrived article articles at available be been blog bought by call check code contact data details developed docs documentation download email find "
    "found from go guide her here him homepage hosted hosting information is it join learn letters listed live located look looked looking looks mail me meet more new "
    "news now online order out page pages posted prices products profile project published read register see seen shop shopping sign site sold source start stay store "
    "them there they today tools try up us use version videos view visit was website we were work worked working works write you".split()
)
_PLUS = re.compile(r"(?i)(?:\+|(?<![a-z])plus)\x20*$")
_SEPARATORS = str.maketrans(",-", "  ")


def _named(text: str) -> bool:
    """Whether a digit's name stands between separators: a cheap search before the machine."""
    spaced = text.lower()
    if "," in spaced or "-" in spaced:
        spaced = spaced.translate(_SEPARATORS)
    return any(f" {name} " in spaced for name in DIGIT_NAMES)


def _in_order(found: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """By start, the longest first; what overlaps an earlier one is left out."""
    out, end = [], 0
    for s, e, new in sorted(found, key=lambda x: (x[0], -x[1])):
        if s >= end:
            out.append((s, e, new))
            end = e
    return out


def _with_plus(text: str, edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spelled digits with the plus sign or word in front of a run, if there is one."""
    out, last = [], -1
    for s, e, new in edits:
        if s != last and (plus := _PLUS.search(text, max(0, s - 8), s)):
            out.append((plus.start(), s, "+"))
        out.append((s, e, new))
        last = e
    return out


def _with_spaces(text: str, edits: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Bracketed signs with the spaces in front of them."""
    out, last = [], 0
    for s, e, new in edits:
        while s > last and text[s - 1] == " ":
            s -= 1
        out.append((s, e, new))
        last = e
    return out


def deobfuscate(text: str) -> Tape:
    """The normalised text on its offset tape.

    Five transducers, each reading what the one before wrote: look-alikes,
    spelled digits, bracketed signs, worded dots between digits, and the
    worded signs and dots of addresses. Each reads a code point a bounded
    number of times, so the work is linear.
    """
    tape = Tape(text)
    if not text.isascii():
        tape = tape.then(LOOKALIKES.edits(text))
    if _named(tape.text):
        tape = tape.then(_with_plus(tape.text, SPELLED_DIGITS.edits(tape.text)))
    if any(c in tape.text for c in "[({<"):
        tape = tape.then(_with_spaces(tape.text, BRACKETED_SIGNS.edits(tape.text)))
    low = tape.text.lower()
    worded = " dot " in low
    if worded:
        tape = tape.then(DIGIT_DOTS.edits(tape.text))
    return tape.then(_worded(tape)) if worded or " at " in low else tape


def _worded(tape: Tape) -> list[tuple[int, int, str]]:
    """Worded signs and dots of the addresses in a text whose other disguises are undone.

    The sign may be "@" or " at ", every dot "." or " dot ". Each sign is looked
    at once, forwards for the domain and backwards for the local part, up to
    the end of the address before.
    """
    text, out, done = tape.text, [], 0
    for sign in _SIGN.finditer(text):
        if sign.start() < done or not (domain := _WORDED_DOMAIN.match(text, sign.end())):
            continue
        start = sign.start()
        while start > done:
            if _LOCAL.match(text, start - 1):
                start -= 1
            elif start < sign.start() and start - 6 >= done and _WORD_DOT.fullmatch(text, start - 5, start) and _LOCAL.match(text, start - 6):
                start -= 6
            else:
                break
        if start == sign.start():
            continue
        end = _domain_end(tape, start, sign, domain)
        if end:
            done = end
            if sign[0] != "@":
                out.append((sign.start(), sign.end(), "@"))
            out += [(x.start(), x.end(), ".") for a, b in ((start, sign.start()), (sign.end(), end)) for x in _WORD_DOT.finditer(text, a, b)]
    return out


def _domain_end(tape: Tape, start: int, sign: re.Match, domain: re.Match) -> int:
    """Where the domain of a worded address ends, 0 if it is none.

    With a sign of an address besides one " at " and one dot (an "@", another
    disguise, a local part that is no plain word) any label of 2 to 24 letters
    may end it, a usual end before others. Without one, or with plain dots
    only, prose says the same ("look at this dot here", "5pm at home.Then"):
    then the end must be a usual one.
    """
    text, at = tape.text, tape.at
    local, ends = text[start : sign.start()], []
    previous, worded = sign.end(), 0
    for dot in [*_SEPARATOR.finditer(text, domain.start(), domain.end()), None]:
        label = text[previous : dot.start() if dot else domain.end()].lower()
        if previous > sign.end() and _END.fullmatch(label):
            ends.append((label, previous + len(label), worded))
        if dot:
            worded += len(dot[0]) > 1
            previous = dot.end()
    host = _SEPARATOR.split(domain[0], maxsplit=1)[0].lower()
    like = bool(_ADDRESS_LIKE.search(local))
    plain = like or local.lower() not in _PROSE_LOCAL and bool(_END.fullmatch(local))
    usual = [x for x in ends if x[0] in _ENDS or x[0] in _MORE_ENDS or len(x[0]) == 2 and x[0] not in _NO_END]
    for label, end, n in reversed(usual) if usual else reversed(ends):
        disguised = bisect_right(at, start) != bisect_right(at, end - 1) or bisect_right(at, start) % 2 == 0
        if sign[0] == "@" or disguised or n > 1 or n and like:
            return end
        if n and usual and host not in _PROSE_HOST:
            return end
        if not n and (label in _ENDS or label in _MORE_ENDS) and host != "www" and plain:
            return end
    return 0


def added(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """Spans that only the normalised text shows, as source offsets.

    A span must take in at least one rewritten stretch, and may not lie within
    a plain span of the same kind.
    """
    tape = deobfuscate(text)
    if not tape.edits:
        return []
    out = []
    for s, e, kind in find(tape.text):
        if not tape.rewritten(s, e):
            continue
        start, end = tape.span(s, e)
        # a separator swallowed by the last rewritten stretch is not part of it
        while end > start and text[end - 1] in " ,-":
            end -= 1
        if not any(k == kind and a <= start and end <= b for a, b, k in base):
            out.append((start, end, kind))
    return out


def listed(spans: list[tuple[int, int, str]]) -> str:
    order = sorted((s, KINDS.index(k), e) for s, e, k in spans)
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in order)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = find(text)
            more = added(text, base)
            kinds = [k for *_, k in base]
            rows.append([*(kinds.count(k) for k in KINDS), sha256_hex(listed(base).encode()), listed(base + more), len(more)])
        columns = list(zip(*rows, strict=True))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4]), pa.array(columns[5]), pa.array(columns[6], pa.int64())],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"],
        )


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of every whole text: ``doc_id``, counts of plain spans, digest of
    the plain spans, all spans, and the number of spans from disguises.

    Needs ``doc_id, text``; other columns are not read. Null and empty texts
    have no spans (digest of the empty list). Repeated rows give repeated
    results, an empty table none. Work per text is linear in its length.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_digests, SCHEMA)


def redact_text(text: str | None) -> str | None:
    """The text with every span, merged where they overlap, named by its kind."""
    if not text:
        return text
    base = find(text)
    out, pos = [], 0
    for s, e, kind in sorted(base + added(text, base), key=lambda x: (x[0], -x[1])):
        if s >= pos:
            out += [text[pos:s], f"[{kind.upper()}]"]
        pos = max(pos, e)
    return "".join([*out, text[pos:]]) if out else text


def _redacted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, "text"):
        at = batch.schema.get_field_index("text")
        texts = [redact_text(t) for t in batch.column("text").to_pylist()]
        yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data replaced in ``text``; a column ``n_chars`` follows the new text. Null stays null."""
    out = map_text(docs, _redacted)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
