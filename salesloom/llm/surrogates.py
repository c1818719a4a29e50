"""Keyed, type-consistent surrogates for personal data, distinct for distinct values all over the corpus."""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salesloom.llm.shared import by_size, stash, table

KEY = b"corpus-surrogates"
DOMAINS = ("example.com", "example.net", "example.org")

# Forms of address by gender, and given names put in their place.
TITLES = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Don", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mlle", "Señora", "Sra", "Doña", "Госпожа"),
    "n": ("Dr", "Prof", "Mx"),
}
GIVEN = {
    ("m", "latin"): ("Adam", "Boris", "Carl", "David", "Emil", "Felix", "Georg", "Hugo", "Ivan", "Jonas", "Karl", "Leon", "Max", "Nils", "Oscar", "Paul"),
    ("f", "latin"): ("Anna", "Berta", "Clara", "Diana", "Emma", "Flora", "Greta", "Helena", "Irma", "Julia", "Karla", "Laura", "Maria", "Nora", "Olga", "Paula"),
    ("n", "latin"): ("Alex", "Chris", "Dana", "Eli", "Jamie", "Kim", "Lou", "Robin", "Sam", "Toni"),
    ("m", "cyrillic"): ("Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Иван", "Олег"),
    ("f", "cyrillic"): ("Анна", "Вера", "Галина", "Дарья", "Елена", "Ирина", "Мария", "Ольга"),
    ("n", "cyrillic"): ("Саша", "Женя", "Валя", "Шура"),
}
LETTERS = {"latin": ("bcdfglmnprst", "aeiou"), "cyrillic": ("бвгдклмнпрст", "аеиоу")}
ENDS = {"latin": {"m": "n", "f": "a", "n": "i"}, "cyrillic": {"m": "н", "f": "а", "n": "и"}}

_name = r"[A-ZÀ-ÖØ-ÞА-Я][^\W\d_]*(?:[-'’][^\W\d_]+)*"
_titles = "|".join(sorted((t for x in TITLES.values() for t in x), key=len, reverse=True))
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"),
    "iban": re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "phone": re.compile(r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w.-])\d{3}-\d{3}-\d{4}(?![\w-])|(?<![\w.+/-])0[1-9]\d{1,3}[ /-]\d{3,8}(?:[ -]\d{2,6}){0,2}(?![\w-])"),
    "card": re.compile(r"(?<![\w.-])(?:\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{13,19})(?![\w-])"),
    "ssn": re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"),
    "ip": re.compile(r"(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\w]|\.\d)"),
    "person": re.compile(rf"(?<!\w)(?P<title>{_titles})\.? (?P<name>{_name}(?: {_name})?)"),
}
GENDER = {t: g for g, x in TITLES.items() for t in x}


DIGIT = re.compile(r"\d")
WORD = re.compile(rf"(?<!\w){_name}(?!\w)")
RUN = re.compile(r"[^\W\d_]+")
POSSESSIVE = re.compile("['’][sS]$")


def luhn(digits: str) -> bool:
    odd = digits[-1::-2]
    even = digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _script(text: str) -> str:
    return "cyrillic" if re.search("[Ѐ-ӿ]", text) else "latin"


def _free(found: list, start: int, end: int) -> bool:
    """Whether a span overlaps none of the sorted, disjoint spans found."""
    i = bisect_left(found, (end,))
    return i == 0 or found[i - 1][1] <= start


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of a text's entities in order, none overlapping; the kind of a person carries gender and script."""
    found: list[tuple[int, int, str, str]] = []
    number = DIGIT.search(text) is not None
    for kind, pattern in PATTERNS.items():
        if kind == "email" and "@" not in text or kind not in ("email", "person") and not number:
            continue
        fresh = []
        for m in pattern.finditer(text):
            start, end, label = m.start(), m.end(), kind
            if kind == "person":
                start, end = m.span("name")
                end -= 2 if POSSESSIVE.search(m["name"]) else 0
                label = f"person-{GENDER[m['title']]}-{_script(m['name'])}"
            elif kind in ("card", "phone"):
                digits = re.sub(r"\D", "", m[0])
                if kind == "card" and len(digits) != 16 and not luhn(digits) or kind == "phone" and len(digits) < 8:
                    continue
            if _free(found, start, end):
                fresh.append((start, end, label, text[start:end]))
        found = sorted(found + fresh)
    return found


def _genders(people: list[tuple[int, int, str, str]]) -> list[str]:
    """Gender of each named person of a text. A neutral title takes what other titles of the text say of the same full name, of the
    given name, or of the family name if one person of the text bears it."""
    said: dict[tuple, set] = {}
    bearers: dict[str, set] = {}
    for _, _, label, value in people:
        gender, (given, _, family) = label.split("-")[1], value.casefold().rpartition(" ")
        if given:
            bearers.setdefault(family, set()).add(given)
        for form in ((given, family), (given, "")) if given else (("", family),):
            said.setdefault(form, set()).update({gender} - {"n"})
    out = []
    for _, _, label, value in people:
        gender, (given, _, family) = label.split("-")[1], value.casefold().rpartition(" ")
        forms = [(given, family), (given, "")] if given else []
        forms += [("", family)] if len(bearers.get(family, ())) <= 1 else []
        known = [next(iter(said[f])) for f in forms if len(said.get(f, ())) == 1]
        out.append(known[0] if gender == "n" and known else gender)
    return out


def pieces(text: str) -> list[tuple[int, int, str, str, str | None]]:
    """(start, end, kind, value, label): what is replaced in a text, in order, and the mention's kind at its first piece.

    Names are replaced word by word, so a full name, its family name and its given name agree wherever they stand. Capitalised words
    that a form of address names anywhere in the text are replaced at all their places, also in compounds and before an apostrophe. Of
    several bearers of a given name that stands alone the last one named before counts, else the first one named.
    """
    found = entities(text)
    people = [x for x in found if x[2].startswith("person-")]
    out: list[tuple[int, int, str, str, str | None]] = [(*x, x[2]) for x in found if not x[2].startswith("person-")]
    if not people:
        return out
    families: dict[str, tuple] = {}
    givens: dict[str, tuple] = {}
    full: dict[tuple, tuple] = {}
    named = []
    for (start, end, _, value), gender in zip(people, _genders(people)):
        given, _, family = value.rpartition(" ")
        cut = end - len(family)
        label = f"person-{gender}-{_script(value)}"
        family_kind, given_kind = f"family-{_script(family)}", f"given-{gender}-{_script(given)}"
        out.append((cut, end, family_kind, family, None if given else label))
        if given:
            out.append((start, cut - 1, given_kind, given, label))
        named.append((start, family.casefold(), (family_kind, label), given.casefold(), (given_kind, label)))
        families.setdefault(family.casefold(), (family_kind, label))
        if given:
            givens.setdefault(given.casefold(), (given_kind, label))
            full.setdefault((given.casefold(), family.casefold()), (given_kind, label))
    at, before = 0, None
    for m in WORD.finditer(text):
        while at < len(named) and named[at][0] <= m.start():
            _, family, f, given, g = named[at]
            families[family] = f
            if given:
                givens[given] = full[given, family] = g
            at += 1
        word = m[0].casefold()
        spans = [m.span()] if word in families or word in givens else [r.span() for r in RUN.finditer(text, m.start(), m.end()) if r[0][0].isupper()]
        for start, end in spans:
            word = text[start:end].casefold()
            if word not in families and word not in givens or not _free(found, start, end):
                continue
            follows = WORD.match(text, end + 1) if text[end : end + 1] == " " else None
            pair = word, follows[0].casefold() if follows else ""
            first = word in givens and (word not in families or pair[1] in families)
            kind, label = full.get(pair, givens[word]) if first else families[word]
            joined = not first and before == start - 1 and text[start - 1] == " "
            out.append((start, end, kind, text[start:end], None if joined else label))
            before = end if first else None
    return sorted(out, key=lambda x: x[0])


def norm(kind: str, value: str) -> str:
    """Spelling-independent form of a value: equal forms are one entity and get one surrogate."""
    if kind == "email":
        return value.lower()
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"\D", "", value)
    return re.sub(r"\s+", "", value).casefold()


class _Draw:
    """Keyed stream of choices for one entity and attempt."""

    def __init__(self, key: bytes, *parts: object):
        self.seed, self.n, self.pool = hmac.new(key, "\x00".join(map(str, parts)).encode(), hashlib.sha256).digest(), 0, b""

    def __call__(self, below: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.sha256(self.seed + self.n.to_bytes(4, "big")).digest()
            self.n += 1
        out, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return out % below


def draw(key: bytes, kind: str, form: str, attempt: int) -> str:
    """Surrogate of a normal form, without its writing: digits, an address, or a word of a name. Later attempts draw longer ones where a form is short, and given names of their own beyond the listed ones."""
    d = _Draw(key, kind, form, attempt)
    if kind == "email":
        local = form.split("@")[0]
        out = "".join(str(d(10)) if c.isdigit() else "abcdefghijklmnopqrstuvwxyz"[d(26)] if c.isalpha() else c for c in local)
        out += "".join("abcdefghijklmnopqrstuvwxyz"[d(26)] for _ in range(max(8 - len(local), 0) + attempt))
        return f"{out}@{DOMAINS[d(len(DOMAINS))]}"
    if kind == "ip":
        return ".".join(["10", *[str(1 + d(254)) for _ in range(3)]]) if attempt < 4 else ".".join(str(1 + d(223)) for _ in range(4))
    if kind == "iban":
        body = "".join(str(d(10)) if c.isdigit() else "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[d(26)] for c in form[4:].upper())
        number = int("".join(str(int(c, 36)) for c in body + form[:2].upper() + "00"))
        return f"{form[:2].upper()}{98 - number % 97:02d}{body}"
    if kind in ("phone", "card", "ssn"):
        keep = 1 if kind in ("card", "phone") else 0
        out = form[:keep] + "".join(str(d(10)) for _ in form[keep:])
        if kind == "card" and luhn(form):
            out = next(out[:-1] + str(c) for c in range(10) if luhn(out[:-1] + str(c)))
        return out
    part, *gender, script = kind.split("-")
    hard, soft = LETTERS[script]

    def syllables(n: int) -> str:
        return "".join(hard[d(len(hard))] + soft[d(len(soft))] for _ in range(n))

    if part == "family":
        return syllables(3 + attempt // 2).capitalize()
    given, end = GIVEN[gender[0], script], ENDS[script][gender[0]]
    if attempt < 2:
        return given[d(len(given))]
    return (syllables(2 + attempt // 2) + ("" if gender[0] == "m" else hard[d(len(hard))]) + end).capitalize()


def written(kind: str, value: str, surrogate: str) -> str:
    """The surrogate in the value's own writing: punctuation and grouping of numbers, upper case of names."""
    if kind in ("phone", "card", "ssn"):
        digits = iter(surrogate)
        return re.sub(r"\d", lambda _: next(digits), value)
    if kind == "iban":
        chars = iter(surrogate)
        return re.sub(r"[A-Za-z0-9]", lambda _: next(chars), value)
    if kind.startswith(("family", "given")) and value.isupper() and len(value) > 1:
        return surrogate.upper()
    return surrogate


PIECES = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string()), ("value", pa.string()), ("label", pa.string()), ("form", pa.string())]))


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.name for f in PIECES.value_type]
    for batch in by_size(batches, "text"):
        rows = [pieces(t) if t else [] for t in batch.column("text").to_pylist()]
        found = pa.array([[dict(zip(names, (*p, norm(p[2], p[3])))) for p in x] or None for x in rows], PIECES)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "text", "text_key")), found], ["doc_id", "text", "text_key", "pieces"])


def meant(forms: DataFrame) -> DataFrame:
    """(kind, form, meant) for distinct (kind, form): a given name of unknown gender takes the only gender that the corpus knows of it."""
    parts = F.split("kind", "-")
    given = F.col("kind").startswith("given-")
    known = forms.where(given & (parts[1] != "n")).groupBy(F.concat(F.lit("given-n-"), parts[2]).alias("kind"), "form").agg(F.min("kind").alias("one"), F.max("kind").alias("last"))
    one = known.where("one = last").select("kind", "form", "one")
    return forms.join(one, ["kind", "form"], "left").select("kind", "form", F.coalesce("one", "kind").alias("meant"))


def resolve(forms: DataFrame, key: bytes = KEY) -> DataFrame:
    """(kind, form, surrogate) for distinct (kind, form): no two forms of a kind share a surrogate, none gets a form that occurs.

    A given name may get another one that occurs, not itself: its family name is new in any case.

    All draw once; of those that drew the same, the one with the smallest hash keeps it, the others and those that drew a value of the
    corpus draw again, until no form is left. Each round is stored.
    """

    def drawn(df: DataFrame, attempt: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([draw(key, k, f, attempt) for k, f in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], pa.string())], ["kind", "form", "surrogate"])

        return df.mapInArrow(run, "kind string, form string, surrogate string")

    settled, open_, attempt = None, forms, 0
    used = F.lower("surrogate")
    while True:
        new = stash(drawn(open_, attempt), "drawn").withColumn("used", used)
        new = new.where("used <> form")
        taken = forms.where("not startswith(kind, 'given-')").select("kind", F.col("form").alias("used"))
        free = new.join(taken, ["kind", "used"], "left_anti")
        if settled is not None:
            free = free.join(settled.select("kind", used.alias("used")), ["kind", "used"], "left_anti")
        owner = free.groupBy("kind", "used").agg(F.min(F.struct(F.xxhash64("form"), "form", "surrogate")).alias("x")).select("kind", F.col("x.form").alias("form"), F.col("x.surrogate").alias("surrogate"))
        settled = stash(owner if settled is None else settled.unionByName(owner), "settled")
        open_ = stash(open_.join(settled, ["kind", "form"], "left_anti"), "open")
        if open_.isEmpty():
            return settled
        attempt += 1


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_size(batches, "text"):
        texts, edits = batch.column("text").to_pylist(), batch.column("edits").to_pylist()
        out, kinds = [], []
        for t, x in zip(texts, edits):
            parts, at = [], 0
            for e in x or ():
                parts += [t[at : e["start"]], written(e["kind"], e["value"], e["surrogate"])]
                at = e["end"]
            out.append(t if not x else "".join([*parts, t[at:]]))
            kinds.append([e["label"] for e in x or () if e["label"]])
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string()), pa.array([len(k) for k in kinds], pa.int64()), pa.array(kinds, pa.list_(pa.string()))], ["doc_id", "text", "n_entities", "kinds"])


def replace_entities(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """(doc_id, text, n_entities, kinds) per document, each entity's mentions replaced by its one surrogate.

    E-mail, IBAN, phone, card, social security and IP numbers, persons after a form of address and all further mentions of their names
    are found in whole texts, in one pass that is stored. Only texts with entities meet their surrogates by a digest of the text; AQE
    splits one that very many documents share. Null texts stay null, empty ones empty, repeated rows repeat, a null doc_id stays null,
    other columns are not read.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text_key", F.md5("text"))
    item = "struct<start: bigint, end: bigint, kind: string, value: string, label: string, form: string>"
    read = stash(plain.mapInArrow(_find, f"doc_id long, text string, text_key string, pieces array<{item}>"), "read")
    mentions = read.where("pieces is not null").select("text_key", F.explode("pieces").alias("p")).select("text_key", "p.*").dropDuplicates(["text_key", "start"])
    mentions = stash(mentions, "mentions")
    forms = stash(meant(mentions.select("kind", "form").distinct()), "forms")
    settled = resolve(stash(forms.select(F.col("meant").alias("kind"), "form").distinct(), "meant"), key)
    names = forms.join(settled.withColumnRenamed("kind", "meant"), ["meant", "form"]).drop("meant")
    edits = mentions.join(names, ["kind", "form"]).groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "value", "surrogate", "label"))).alias("edits"))
    hits = read.where("pieces is not null").select("doc_id", "text", "text_key").join(edits, "text_key").select("doc_id", "text", "edits")
    rest = read.where("pieces is null").select("doc_id", "text", F.lit(0).cast("long").alias("n_entities"), F.array().cast("array<string>").alias("kinds"))
    return hits.mapInArrow(_rewrite, "doc_id long, text string, n_entities long, kinds array<string>").unionByName(rest)


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All `documents` with surrogates."""
    return replace_entities(table(spark, sf_dir, "documents"))
