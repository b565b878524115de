"""Keyed pseudonyms for personal data that keep its format: equal values stay equal across documents.

Built-in functions only. Every pseudonym is a Feistel permutation of the values of its kind: the two halves of a value are
changed in turn by a keyed hash of the other half, so no two values of a kind collide, and no table of them is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.columns import bind

ROUNDS = 8
#: How cards are written as a rule: in one, by fours with or without three more, or 4-6-5 and 4-6-4.
CARD_LAYOUT = r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{3})?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9A-Za-z])"
#: How the numbers of card issuers begin, and how long they are; four digits tell the issuer.
ISSUERS = (
    "^(?:4(?:[0-9]{15}|[0-9]{18})|(?:5[1-5][0-9]{2}|222[1-9]|22[3-9][0-9]|2[3-6][0-9]{2}|27[01][0-9]|2720)[0-9]{12}"
    "|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9]|9[0-9])[0-9]{11}|(?:6011|64[4-9][0-9]|65[0-9]{2}|62[0-9]{2}|352[89]|35[3-8][0-9])[0-9]{12,15}"
    "|(?:5018|5020|5038|5893|6304|6759|676[1-3])[0-9]{9,15})$"
)
#: How the first group of a card or an IBAN begins, and a group of four digits.
HEAD, FOUR = "^[ -]?(?:[A-Z]{2}[0-9]{2}|[2-6])", "^[ -]?[0-9]{4}$"
DIGITS = "0123456789"
HEX = "0123456789abcdef"
LOWER = "abcdefghijklmnopqrstuvwxyz"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: What each kind looks like, in the order they are tried. Bounded repeats only.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "access_key": r"(?<![A-Za-z0-9])A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])",
    "hex_secret": r"(?<![A-Za-z0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])",
    "ip": r"(?<![0-9.])(?<![Vv]ersion )(?<![Rr]elease )(?<![Bb]uild )(?<![Vv]er )(?<![Vv]er\. )(?<![Vv])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9])(?!\.[0-9])",
    "date": r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}"
            r"|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9/-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9A-Za-z+(])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
             rf"|(?<![0-9A-Za-z+])\+[0-9]{{1,3}}(?=(?:[ .-]?[0-9]){{7}})(?:[ .-](?!{CARD_LAYOUT})[0-9]{{1,4}}){{3,7}}(?![0-9])"
             rf"|(?<![0-9A-Za-z+])\+[0-9]{{1,3}}(?:[ .-](?!{CARD_LAYOUT})[0-9]{{2,4}}){{2,4}}(?![0-9])",
    "card": r"(?<![0-9A-Za-z])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z])",
}
#: Kinds that may stand beside more digits or capitals, and how the run of groups that may hold one begins.
IN_RUNS = {"iban": r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2}", "card": r"[0-9](?:[ -]?[0-9]){12}"}
#: Most groups of one value: a card written digit by digit.
MAX_GROUPS = 19
#: What any value of the kinds above contains.
NEEDED = "[0-9@]|A[KS]IA"
#: Years 1700 to 2099: one whole cycle of the calendar, 189 x 773 days.
FIRST_DAY, DAY_PARTS = "1700-01-01", (189, 773)
#: Areas 001-899 without 666, groups 01-99 and serials 0001-9999.
SSN_PARTS = (898 * 99, 9999)


def _prf(key: str, kind: str, turn: Column, half: Column) -> Column:
    return F.sha2(F.concat(F.lit(f"{key}|{kind}|"), turn.cast("string"), F.lit("|"), half.cast("string")), 256)


def permute_pair(left: Column, right: Column, parts: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of the pairs of whole numbers below ``parts``; fields ``l`` and ``r``."""
    def added(value: Column, other: Column, turn: Column, size: int) -> Column:
        drawn = F.conv(F.substring(_prf(key, kind, turn, other), 1, 15), 16, 10).cast("long")
        return (value + drawn) % size

    def turn(acc: Column, i: Column) -> Column:
        return F.struct(acc["r"].alias("r"), added(acc["l"], acc["r"], 2 * i, parts[0]).alias("l"))

    def both(acc: Column, i: Column) -> Column:
        moved = turn(acc, i)
        return F.struct(moved["l"].alias("l"), added(acc["r"], moved["l"], 2 * i + 1, parts[1]).alias("r"))

    turns = F.sequence(F.lit(0), F.lit(ROUNDS // 2 - 1))
    return F.aggregate(turns, F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")), both)


def permute_text(value: Column, alphabet: str, key: str, kind: str) -> Column:
    """A permutation of the strings of one length over ``alphabet``."""
    half = F.floor(F.length(value) / 2).cast("int")

    def added(x: Column, other: Column, turn: Column) -> Column:
        def all_moved(hashed: Column) -> Column:
            def moved(c: Column, i: Column) -> Column:
                drawn = F.conv(F.substr(hashed, (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")
                place = F.position(c, F.lit(alphabet)) - 1 + drawn
                return F.substr(F.lit(alphabet), place % len(alphabet) + 1, F.lit(1))

            return F.concat_ws("", F.transform(F.split(x, ""), moved))

        return bind(_prf(key, kind, turn, other), all_moved)

    def turn(acc: Column, i: Column) -> Column:
        return F.struct(acc["r"].alias("l"), added(acc["l"], acc["r"], i).alias("r"))

    halves = F.struct(F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + 1).alias("r"))
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), halves, turn, lambda done: F.concat(done["l"], done["r"])
    )


def only(value: Column, alphabet: str) -> Column:
    return F.regexp_replace(value, f"[^{alphabet}]", "")


def put_back(value: Column, alphabet: str, new: Column) -> Column:
    """``value`` with its characters of ``alphabet`` replaced, in order, by those of ``new``."""
    def filled(pair: Column) -> Column:
        def placed(c: Column, i: Column) -> Column:
            before = F.length(only(F.substr(pair["value"], F.lit(1), i), alphabet))
            return F.when(F.lit(alphabet).contains(c), F.substr(pair["new"], before + 1, F.lit(1))).otherwise(c)

        return F.concat_ws("", F.transform(F.split(pair["value"], ""), placed))

    return bind(F.struct(value.alias("value"), new.alias("new")), filled)


def _permuted_class(value: Column, alphabet: str, key: str, kind: str) -> Column:
    return put_back(value, alphabet, permute_text(only(value, alphabet), alphabet, key, kind))


def _email(m: Column, key: str) -> Column:
    local = F.substring_index(m, "@", 1)
    for alphabet in (LOWER, UPPER, DIGITS):
        local = _permuted_class(local, alphabet, key, f"email{len(alphabet)}")
    return F.concat(local, F.lit("@"), F.substring_index(m, "@", -1))


def _mod97(code: Column) -> Column:
    def step(acc: Column, c: Column) -> Column:
        letter = F.ascii(c).cast("long") - 55
        return F.when(c >= "A", (acc * 100 + letter) % 97).otherwise((acc * 10 + c.cast("long")) % 97)

    return F.aggregate(F.split(code, ""), F.lit(0).cast("long"), step)


def _iban(m: Column, key: str) -> Column:
    plain = F.replace(m, F.lit(" "))
    valid = _mod97(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))) == 1
    body = F.substr(plain, F.lit(5))
    body = put_back(body, DIGITS, permute_text(only(body, DIGITS), DIGITS, key, "iban"))
    country = F.substr(plain, F.lit(1), F.lit(2))

    def written(new: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
        return put_back(m, UPPER + DIGITS, F.concat(country, check, new))

    return F.when(valid, bind(body, written))


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    pair = permute_pair(octets[0] * 256 + octets[1], octets[2] * 256 + octets[3], (1 << 16, 1 << 16), key, "ip")

    def written(p: Column) -> Column:
        parts = [F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256]
        return F.concat_ws(".", *[x.cast("string") for x in parts])

    return F.when(F.forall(octets, lambda x: x < 256), bind(pair, written))


def _date(m: Column, key: str) -> Column:
    """Year first, or month before day, or day before month where the month could not come first or dots part them."""
    first, second = F.substr(m, F.lit(1), F.lit(2)), F.substr(m, F.lit(4), F.lit(2))
    iso = m.rlike("^[0-9]{4}")
    day_first = m.contains(".") | (first > "12")
    year = F.when(iso, F.substr(m, F.lit(1), F.lit(4))).otherwise(F.substr(m, F.lit(7), F.lit(4)))
    month = F.when(iso, F.substr(m, F.lit(6), F.lit(2))).when(day_first, second).otherwise(first)
    day = F.when(iso, F.substr(m, F.lit(9), F.lit(2))).when(day_first, first).otherwise(second)
    start = F.to_date(F.lit(FIRST_DAY))
    number = F.datediff(F.try_to_date(F.concat_ws("-", year, month, day), "yyyy-MM-dd"), start)
    a, b = DAY_PARTS
    pair = permute_pair(F.floor(number / b), number % b, DAY_PARTS, key, "date")

    def written(new: Column) -> Column:
        y, mo, d = (F.date_format(new, part) for part in ("yyyy", "MM", "dd"))
        mark = F.when(iso, F.substr(m, F.lit(5), F.lit(1))).otherwise(F.substr(m, F.lit(3), F.lit(1)))
        short = F.when(day_first, F.concat(d, mark, mo, mark, y)).otherwise(F.concat(mo, mark, d, mark, y))
        return F.when(iso, F.concat(y, mark, mo, mark, d)).otherwise(short)

    new = bind(bind(pair, lambda p: F.date_add(start, (p["l"] * b + p["r"]).cast("int"))), written)
    return F.when((number >= 0) & (number < a * b), new)


def _ssn(m: Column, key: str) -> Column:
    area, group, serial = (F.substr(m, F.lit(at), F.lit(n)).cast("long") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    index = area - F.when(area > 666, 2).otherwise(1)
    pair = permute_pair(index * 99 + group - 1, serial - 1, SSN_PARTS, key, "ssn")

    def written(p: Column) -> Column:
        at = F.floor(p["l"] / 99)
        numbers = ((at + F.when(at >= 665, 2).otherwise(1), 3), (p["l"] % 99 + 1, 2), (p["r"] + 1, 4))
        return F.concat_ws("-", *[F.lpad(x.cast("string"), n, "0") for x, n in numbers])

    return F.when(valid, bind(pair, written))


def _phone(m: Column, key: str) -> Column:
    """The country code stays, so a number has one pseudonym with and without it."""
    code = F.regexp_extract(m, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    return F.concat(code, _permuted_class(F.substr(m, F.length(code) + 1), DIGITS, key, "phone"))


def is_card(digits: Column) -> Column:
    """Of an issuer, as long as its numbers are, and with a right check digit."""
    return digits.rlike(ISSUERS) & F.call_function("luhn_check", digits)


def _card(m: Column, key: str) -> Column:
    """The issuer's four digits stay, so the pseudonym is a number of the same issuer."""
    digits = only(m, DIGITS)
    body = permute_text(F.substr(digits, F.lit(5), F.length(digits) - 5), DIGITS, key, "card")

    def checked(new: Column) -> Column:
        whole = F.concat(F.substr(digits, F.lit(1), F.lit(4)), new)
        valid = F.filter(F.array(*[F.lit(d) for d in DIGITS]), lambda d: F.call_function("luhn_check", F.concat(whole, d)))
        return F.concat(whole, F.get(valid, F.lit(0)))

    return F.when(is_card(digits), put_back(m, DIGITS, bind(body, checked)))


def _access_key(m: Column, key: str) -> Column:
    body = permute_text(F.substr(m, F.lit(5)), UPPER + DIGITS, key, "access_key")
    return F.concat(F.substr(m, F.lit(1), F.lit(4)), body)


def _hex(m: Column, key: str) -> Column:
    return F.when(m.rlike("[0-9]") & m.rlike("[a-f]"), permute_text(m, HEX, key, "hex"))


KINDS = {
    "email": _email, "iban": _iban, "access_key": _access_key, "hex_secret": _hex, "ip": _ip, "date": _date,
    "ssn": _ssn, "phone": _phone, "card": _card,
}


def pseudonym(match: Column, key: str, kinds: tuple[str, ...] = tuple(KINDS)) -> Column:
    """The pseudonym of a value; null if it is valid as none of ``kinds``."""
    tries = [F.when(match.rlike(f"^(?:{PATTERNS[k]})$"), KINDS[k](match, key)) for k in kinds]
    return F.coalesce(*tries, F.lit(None).cast("string"))


def candidates(kinds: tuple[str, ...]) -> str:
    """The pattern of what may be or hold a value. Cards and IBANs are looked for in whole runs of groups, up to a value
    of another kind; nothing of a run is given back, so its length costs neither stack nor repeated search."""
    single = [f"(?:{PATTERNS[k]})" for k in kinds if k not in IN_RUNS]
    heads = [IN_RUNS[k] for k in kinds if k in IN_RUNS]
    group = "[A-Z0-9]++(?![a-z])"
    other = f"(?!{'|'.join(single)})" if single else ""
    run = [rf"(?:(?<![0-9A-Za-z])(?={'|'.join(heads)}){group}(?:[ -]{other}{group})*+)"] if heads else []
    return "|".join(single + run)


def replace_in_run(run: Column, key: str, kinds: tuple[str, ...]) -> Column:
    """A run of groups with every valid stretch of whole groups replaced, from left to right, the longest first.

    A card that is not the whole run has at least three digits in each group, else numbers of a table would too often
    make one by chance. For the same reason a card of groups of four has at most one other group of four beside it (a year,
    say) that is in no value itself: longer rows are of years or codes. A stretch in an unusual layout gives way to one in a usual layout that
    begins within it. Only groups that an issuer's number or an IBAN can begin with are looked at closely.
    """
    usual = f"^(?:{CARD_LAYOUT}|[A-Z].*)$"

    def best(groups: Column, i: Column) -> Column:
        def stretch(k: Column) -> Column:
            text = F.ltrim(F.concat_ws("", F.slice(groups, i + 1, k)), F.lit(" -"))
            return F.struct(k.alias("k"), text.alias("text"))

        def fits(x: Column) -> Column:
            apart = (x["k"] == F.size(groups)) | x["text"].rlike("^(?:[A-Z]{2}[0-9]{2}|[0-9]{3,}(?:[ -][0-9]{3,})*$)")
            return F.length(x["text"]).between(13, 45) & apart & (x["text"].rlike("[A-Z]") | is_card(only(x["text"], DIGITS)))

        def renamed(x: Column) -> Column:
            return F.struct(x["k"].alias("k"), x["text"].rlike(usual).alias("usual"), pseudonym(x["text"], key, kinds).alias("new"))

        longest = F.least(F.lit(MAX_GROUPS), F.size(groups) - i)
        every = F.transform(F.sequence(longest, F.lit(1), F.lit(-1)), stretch)
        found = bind(
            F.filter(F.transform(F.filter(every, fits), renamed), lambda x: x["new"].isNotNull()),
            lambda valid: F.coalesce(F.get(F.filter(valid, lambda x: x["usual"]), F.lit(0)), F.get(valid, F.lit(0))),
        )
        return F.when(F.get(groups, i).rlike(HEAD), found)

    def joined(x: Column) -> Column:
        groups, found = x["groups"], x["found"]
        placed = F.transform(found, lambda f, i: F.struct(i.alias("i"), f["k"].alias("k"), f["usual"].alias("usual"), f["new"].alias("new")))

        def is_four(i: Column) -> Column:
            return F.coalesce(F.get(groups, i).rlike(FOUR), F.lit(False))

        def step(acc: Column, hit: Column) -> Column:
            i, end = hit["i"], hit["i"] + hit["k"]
            within = F.slice(found, i + 2, hit["k"] - 1)
            fours = F.forall(F.slice(groups, i + 1, hit["k"]), lambda g: g.rlike(FOUR))
            free = F.coalesce(F.get(found, end)["new"], F.lit("")) == ""
            before, after = (i > 0) & (acc["next"] != i) & is_four(i - 1), is_four(end) & free
            more = before & (i > 1) & (acc["next"] != i - 1) & is_four(i - 2) | after & is_four(end + 1)
            taken = (i >= acc["next"]) & ~(fours & (before & after | more)) & (
                hit["usual"] | ~F.exists(within, lambda y: F.coalesce(y["usual"], F.lit(False)))
            )
            return F.struct(
                F.when(taken, end).otherwise(acc["next"]).alias("next"),
                F.when(taken, F.concat(acc["taken"], F.array(hit))).otherwise(acc["taken"]).alias("taken"),
            )

        def between(start: Column, end: Column) -> Column:
            return F.concat_ws("", F.slice(groups, start + 1, F.greatest(end - start, F.lit(0))))

        def written(acc: Column) -> Column:
            def piece(hit: Column, j: Column) -> Column:
                before = F.get(acc["taken"], j - 1)
                start = F.when(j == 0, 0).otherwise(before["i"] + before["k"])
                mark = F.regexp_extract(F.get(groups, hit["i"]), "^[ -]?", 0)
                return F.concat(between(start, hit["i"]), mark, hit["new"])

            return F.concat_ws("", F.transform(acc["taken"], piece), between(acc["next"], F.size(groups)))

        hits = F.filter(placed, lambda hit: hit["new"].isNotNull())
        return bind(hits, lambda h: F.aggregate(h, F.struct(F.lit(0).alias("next"), F.slice(h, 1, 0).alias("taken")), step, written))

    def searched(groups: Column) -> Column:
        found = F.transform(F.sequence(F.lit(0), F.size(groups) - 1), lambda i: best(groups, i))
        return bind(F.struct(groups.alias("groups"), found.alias("found")), joined)

    return bind(F.split(run, "(?=[ -])"), searched)


def pseudonymise(text: Column, key: str, kinds: tuple[str, ...] = tuple(KINDS)) -> Column:
    """The text with every valid value of ``kinds`` replaced; all else unchanged, null stays null."""
    pattern = candidates(kinds)
    single, in_runs = (tuple(k for k in kinds if (k in IN_RUNS) == of_runs) for of_runs in (False, True))

    def replaced(m: Column) -> Column:
        tries = [pseudonym(m, key, single)] if single else []
        if in_runs:
            # Only cards and IBANs are as long and written in digits and capitals alone.
            run = m.rlike("^[A-Z0-9]++(?:[ -][A-Z0-9]++)*+$") & (F.length(m) >= 13)
            tries.append(F.when(run, replace_in_run(m, key, in_runs)))
        return F.coalesce(*tries, m)

    found, between = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    new = F.transform(found, replaced)
    joined = F.concat_ws("", F.flatten(F.transform(
        F.arrays_zip(between.alias("t"), new.alias("n")), lambda x: F.array(x["t"], F.coalesce(x["n"], F.lit("")))
    )))
    # Most texts hold no character that every kind needs; a scan for one is much cheaper than the pattern.
    return F.when(text.rlike(NEEDED), joined).otherwise(text)


def pseudonymise_documents(
    docs: DataFrame, key: str, text: str = "text", kinds: tuple[str, ...] = tuple(KINDS)
) -> DataFrame:
    """``docs`` with the values in ``text`` replaced; rows, other columns and their order are unchanged.

    Numbers must be valid to count (issuer, length and Luhn sum of cards, check digits of IBANs, octets, social security ranges, days of
    the calendar from 1700 to 2099); a look-alike stays as it is. Cards and IBANs are also found where more groups of
    digits or capitals stand before or after them, which stay; see ``replace_in_run``. Pseudonyms are valid in the same way and keep
    separators, lengths and letter case. Null and empty texts stay; no rows in, no rows out.
    """
    return docs.withColumn(text, pseudonymise(F.col(text), key, kinds))
