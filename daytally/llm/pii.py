"""Personal data by weak supervision, with DataFrame functions only.

Base spans (e-mail, ip, card, phone) follow fixed patterns and checks and always stay.  Beyond them,
a broad pattern proposes candidates (assigned or bare secrets, social security numbers, bank
accounts, names after a title, street addresses).  Regex, gazetteer and context labelers vote +1,
-1 or abstain on each candidate.  Expectation-maximisation over the counts of vote patterns of the
whole corpus estimates every labeler's reliability and each pattern's probability; with these as
soft labels a logistic span classifier is trained on the candidates' shape features.  A
candidate that the classifier accepts and that overlaps no base span is added.

All texts are read by built-in functions, without a shuffle: positions come from the lengths of the
matches and of the gaps between them.  Votes and features have few values, so what reaches the driver
is a table of pattern counts whose size is bounded by their combinations.

Patterns are written so that matching is linear in the text (possessive loops; a match starts at the
head of its run of characters), with the same matches as the plain forms.

Defined cases: a null text is empty; documents without a span have zero counts and empty
strings; rows are judged one by one, so repeated rows and null ids need no rule; without candidates
no classifier is trained and the base spans are all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ["email", "ip", "card", "phone", "secret", "ssn", "iban", "name", "address"]

# Equal to the plain patterns: the first character of a run either follows another character or the last match.
_EMAIL = (r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Gazetteers (fixed values).
SECRET_WORDS = ["password", "passwd", "pwd", "passwort", "contraseña", "secret", "token", "apikey", "api_key",
                "access_key", "auth", "credential", "private_key"]
PLAIN_WORDS = ["page", "ref", "lang", "version", "width", "height", "color", "class", "style", "href", "src", "charset",
               "commit", "checksum", "md5", "sha1", "sha256", "uuid"]
TITLES = ["Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Monsieur", "Madame", "Señor", "Señora"]
FIRST_NAMES = ["James", "John", "Robert", "Michael", "David", "William", "Mary", "Linda", "Susan", "Sarah", "Anna", "Maria",
               "Peter", "Hans", "Klaus", "Ursula", "Pierre", "Jean", "Marie", "Sophie", "Carlos", "Juan", "José", "Carmen"]
STREETS = ["Street", "Avenue", "Road", "Lane", "Boulevard", "Drive"]
CUES = ["password", "login", "account", "user", "ssn", "social security", "iban", "name", "address", "born", "passwort",
        "konto", "mot de passe", "compte", "contraseña", "cuenta", "token", "key", "secret"]

_CANDIDATES = "|".join([
    r"\b(?i:" + "|".join(SECRET_WORDS + PLAIN_WORDS) + r")\x20?[=:]\x20?[\"']?[A-Za-z0-9+/_.-]{6,}+[\"']?",
    r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b",
    r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b",
    r"\b(?=[0-9]*+[a-f])(?=[a-f]*+[0-9])[0-9a-f]{32,}+\b",
    r"\b(?:" + "|".join(TITLES) + r")\.?\x20\p{Lu}\p{Ll}++(?:\x20\p{Lu}\p{Ll}++)?+",
    r"\b[0-9]{1,5}\x20\p{Lu}\p{Ll}++\x20(?:" + "|".join(STREETS) + r")\b",
])

_BLOCK = 128


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once per row however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of a pattern's leftmost matches, in code points.

    A match starts after the gaps and matches before it; sums over blocks keep long texts cheap.
    """
    def placed(v: Column) -> Column:
        return F.transform(v["m"], lambda m, i: F.struct(
            (_sum(F.slice(v["block"], F.lit(1), F.floor(i / _BLOCK).cast("int")))
             + _sum(F.slice(v["step"], i - i % _BLOCK + 1, i % _BLOCK)) + F.get(v["g"], i)).alias("start"),
            m.alias("match")))

    def stepped(u: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(u["m"]) / _BLOCK).cast("int")),
                             lambda b: _sum(F.slice(u["step"], b * _BLOCK + 1, F.lit(_BLOCK))))
        return let(F.struct(u["g"].alias("g"), u["m"].alias("m"), u["step"].alias("step"), blocks.alias("block")), placed)

    def measured(s: Column) -> Column:
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        return let(F.struct(gaps.alias("g"), s.alias("m")), lambda t: let(
            F.struct(t["g"].alias("g"), t["m"].alias("m"),
                     F.zip_with(F.transform(t["m"], F.length), F.slice(t["g"], F.lit(1), F.size(t["m"])),
                                lambda a, b: a + b).alias("step")), stepped))

    found = let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                lambda s: F.when(F.size(s) > 0, measured(s)))
    return F.transform(F.coalesce(found, F.array().cast("array<struct<start:int,match:string>>")),
                       lambda x: F.struct(x["start"].alias("start"),
                                          (x["start"] + F.length(x["match"])).alias("end"), x["match"].alias("match")))


def _ip_ok(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


def _luhn(digits: Column) -> Column:
    """The Luhn sum of at most 20 digits is a multiple of ten; every second digit from the right is doubled."""
    plain = F.lpad(digits, 20, "0")
    twice = F.translate(plain, "0123456789", "0246813579")
    total = sum((F.substring(twice if k % 2 else plain, k, 1).cast("int") for k in range(1, 21)), F.lit(0))
    return total % 10 == 0


def _card_ok(match: Column) -> Column:
    return let(F.translate(match, " -", ""), lambda d: F.when(F.length(d).between(12, 19), _luhn(d)).otherwise(False))


def _phone_ok(match: Column) -> Column:
    return F.length(F.translate(match, "+ ().-", "")).between(9, 15)


def _kind(spans: Column, kind: str) -> Column:
    return F.transform(spans, lambda x: F.struct(x["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                                                 F.lit(kind).alias("kind"), x["end"].alias("end")))


_NONE = "array<struct<start:int,end:int,match:string>>"


def base_spans(text: Column) -> Column:
    """Sorted array of (start, rank, kind, end) of the base kinds; cheap tests skip texts without any."""
    def some(test: Column, pattern: str) -> Column:
        return F.when(test, matches(text, pattern)).otherwise(F.array().cast(_NONE))

    email = some(F.contains(text, F.lit("@")), _EMAIL)
    ip = F.filter(some(text.rlike(r"[0-9]\.[0-9]++\."), _IP), lambda x: _ip_ok(x["match"]))
    card = F.filter(some(text.rlike(r"[0-9](?:[\x20-]?[0-9]){11}"), _CARD), lambda x: _card_ok(x["match"]))
    phone = F.filter(some(F.contains(text, F.lit("+")), _PHONE), lambda x: _phone_ok(x["match"]))
    return F.array_sort(F.concat(_kind(email, "email"), _kind(ip, "ip"), _kind(card, "card"), _kind(phone, "phone")))


def _any(text: Column, words: Iterable[str]) -> Column:
    return text.rlike("(?i)(?:" + "|".join(words) + ")")


def _candidate_kind(match: Column) -> Column:
    return (F.when(match.rlike(r"^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
            .when(match.rlike(r"^[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}$") & ~match.rlike("^A[KS]IA"), "iban")
            .when(match.rlike("^(?:" + "|".join(TITLES) + r")\.?\x20"), "name")
            .when(match.rlike(r"^[0-9]{1,5}\x20\p{Lu}"), "address").otherwise("secret"))


def _value(match: Column) -> Column:
    """What is assigned: the part after = or :, without quotes; else the whole."""
    return F.translate(F.regexp_replace(match, r"^[^=:]*[=:]\x20?", ""), "\"'", "")


# Each labeler votes 1 (personal), -1 (not) or 0 (abstains) on (match, value, text before, text after, kind).
def _votes(match: Column, value: Column, before: Column, after: Column, kind: Column) -> dict[str, Column]:
    mixed = value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.length(value) >= 8)
    form = match.rlike(r"^(?:A[KS]IA[A-Z0-9]{16}|[0-9]{3}-[0-9]{2}-[0-9]{4})$") | (
        (kind == "iban") & match.rlike(r"^(?:DE[0-9]{20}|FR[0-9]{12}|ES[0-9]{22}|GB[0-9]{2}[A-Z]{4}[0-9]{14})"))
    return {
        "regex_form": F.when(form, 1).when(value.rlike(r"^[a-z]+$"), -1).otherwise(0),
        "regex_mix": F.when(mixed, 1).when((kind == "secret") & ~form, -1).otherwise(0),
        "gazetteer_secret": F.when(_any(match, SECRET_WORDS), 1).when(_any(match, PLAIN_WORDS), -1).otherwise(0),
        "gazetteer_name": F.when((kind == "name") & _any(match, FIRST_NAMES), 1).otherwise(0),
        "context_cue": F.when(_any(before, CUES), 1).otherwise(0),
        "context_plain": F.when(_any(before, PLAIN_WORDS) | before.rlike(r"[/&?#]$") | after.rlike(r"^[/=]"), -1)
        .otherwise(0),
    }


LABELERS = ["regex_form", "regex_mix", "gazetteer_secret", "gazetteer_name", "context_cue", "context_plain"]


def _share(value: Column, chars: str) -> Column:
    """Share of a character class, in four steps."""
    return F.floor(4.0 * F.length(F.regexp_replace(value, f"[^{chars}]", "")) / (F.length(value) + 1)).cast("int")


def _features(match: Column, value: Column, kind: Column) -> dict[str, Column]:
    return {"kind": kind, "size": F.least(F.floor(F.log2(F.length(value) + 1)), F.lit(7)).cast("string"),
            "digits": _share(value, "0-9").cast("string"), "upper": _share(value, "A-Z").cast("string"),
            "assigned": match.rlike("[=:]").cast("string")}


FEATURES = ["kind", "size", "digits", "upper", "assigned"]


def candidates(text: Column) -> Column:
    """Array of candidate spans with kind, votes and features."""
    def described(x: Column) -> Column:
        parts = F.struct(x["start"].alias("start"), x["end"].alias("end"), x["match"].alias("match"),
                         _value(x["match"]).alias("value"), _candidate_kind(x["match"]).alias("kind"),
                         F.substring(text, F.greatest(x["start"] - 23, F.lit(1)), F.least(x["start"], F.lit(24)))
                         .alias("before"),
                         F.substring(text, x["end"] + 1, F.lit(8)).alias("after"))
        return let(parts, lambda p: F.struct(
            p["start"].alias("start"), p["end"].alias("end"), p["kind"].alias("kind"),
            F.struct(*(v.alias(k) for k, v in _votes(p["match"], p["value"], p["before"], p["after"], p["kind"]).items()))
            .alias("votes"),
            F.struct(*(v.alias(k) for k, v in _features(p["match"], p["value"], p["kind"]).items())).alias("features")))

    return F.transform(matches(text, _CANDIDATES), described)


def reliabilities(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 60) -> tuple[list[float], dict]:
    """EM over (votes, count): the probability of each pattern and every labeler's vote shares per class."""
    # Votes start out as mostly right.
    prior = 0.5
    share = {k: {c: {v: (0.6 if v == (1 if c else -1) else 0.1 if v else 0.3) for v in (-1, 0, 1)} for c in (0, 1)}
             for k in range(len(LABELERS))}
    chance = [0.5] * len(patterns)
    for _ in range(rounds):
        for i, (votes, _) in enumerate(patterns):
            odds = math.log(prior / (1 - prior)) + sum(
                math.log(share[k][1][v] / share[k][0][v]) for k, v in enumerate(votes))
            chance[i] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
        total = sum(n for _, n in patterns)
        good = sum(p * n for p, (_, n) in zip(chance, patterns, strict=True))
        prior = min(0.99, max(0.01, (good + 1) / (total + 2)))
        for k in range(len(LABELERS)):
            for c in (0, 1):
                # Ten imagined candidates keep the first opinion where a class is rarely seen.
                seen = {v: 10 * (0.6 if v == (1 if c else -1) else 0.1 if v else 0.3) for v in (-1, 0, 1)}
                for p, (votes, n) in zip(chance, patterns, strict=True):
                    seen[votes[k]] += n * (p if c else 1 - p)
                every = sum(seen.values())
                share[k][c] = {v: s / every for v, s in seen.items()}
    return chance, share


def span_classifier(rows: list[tuple[dict[str, str], float, int]], steps: int = 400) -> dict[str, float]:
    """Logistic regression on one-hot features with soft labels (features, probability, count); by gradient steps."""
    weight: dict[str, float] = {"": 0.0}
    keyed = [([f"{k}={v}" for k, v in features.items()] + [""], p, n) for features, p, n in rows]
    for keys, _, _ in keyed:
        for key in keys:
            weight.setdefault(key, 0.0)
    total = sum(n for _, _, n in keyed)
    for _ in range(steps):
        slope = {k: 0.002 * w for k, w in weight.items()}
        for keys, p, n in keyed:
            z = sum(weight[k] for k in keys)
            error = (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))) - p) * n / total
            for k in keys:
                slope[k] += error
        for k in weight:
            weight[k] -= 2.0 * slope[k]
    return weight


def train(docs: DataFrame, text_col: str = "text") -> dict[str, float] | None:
    """Fit labelers and classifier on the candidates of all documents; None without candidates."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    each = docs.select(F.explode(candidates(text)).alias("c"))
    counts = (each.select(*(F.col(f"c.votes.{k}").alias(f"v_{k}") for k in LABELERS),
                          *(F.col(f"c.features.{k}").alias(f"f_{k}") for k in FEATURES))
              .groupBy(*(f"v_{k}" for k in LABELERS), *(f"f_{k}" for k in FEATURES)).agg(F.count("*").alias("n")))
    rows = sorted((tuple(r[f"v_{k}"] for k in LABELERS), tuple(r[f"f_{k}"] for k in FEATURES), r["n"])
                  for r in counts.collect())
    if not rows:
        return None
    votes: dict[tuple[int, ...], int] = {}
    for v, _, n in rows:
        votes[v] = votes.get(v, 0) + n
    patterns = sorted(votes.items())
    chance = dict(zip((v for v, _ in patterns), reliabilities(patterns)[0], strict=True))
    return span_classifier([(dict(zip(FEATURES, f, strict=True)), chance[v], n) for v, f, n in rows])


def _accepted(features: Column, weight: dict[str, float]) -> Column:
    table = F.create_map(*(F.lit(x) for kv in sorted(weight.items()) for x in kv))
    total = F.lit(weight[""])
    for k in FEATURES:
        total = total + F.coalesce(F.element_at(table, F.concat(F.lit(f"{k}="), features[k])), F.lit(0.0))
    return total > 0


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, base and spans (sorted arrays of start, rank, kind, end) of every document."""
    weight = train(docs, text_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", "text", base_spans(F.col("text")).alias("base"))
    if weight is None:
        return rows.select("doc_id", "base", F.col("base").alias("spans"))
    ranks = F.create_map(*(F.lit(x) for k in KINDS for x in (k, KINDS.index(k))))
    added = F.filter(candidates(F.col("text")), lambda c: _accepted(c["features"], weight) & ~F.exists(
        F.col("base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    added = F.transform(added, lambda c: F.struct(c["start"].alias("start"), ranks[c["kind"]].alias("rank"),
                                                  c["kind"].alias("kind"), c["end"].alias("end")))
    return rows.select("doc_id", "base", F.array_sort(F.concat("base", added)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
