"""Labels by ordered keyword rules."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from annalist.functions.coerce import trimmed

#: (label, alternatives); an alternative is a list of texts that all have to be there, `!x` not, `=x` as the whole text, `~x` as a word.
Rules = list[tuple[str, list[list[str]]]]

# Standard school types and the words that tell them, in order of precedence.
SCHOOL_TYPES: Rules = [
    ("Community School", [["=cy"]]),
    ("Foundation School", [["=fd"]]),
    ("Voluntary Aided School", [["=va"]]),
    ("Voluntary Controlled School", [["=vc"]]),
    ("Academy - Converter Special", [["academy", "converter", "special"]]),
    ("Academy - Sponsor Led Special", [["academy", "sponsor", "special"]]),
    ("Academy - Converter", [["academy", "converter"]]),
    ("Academy - Sponsor Led", [["academy", "sponsor"]]),
    ("Academy - Special School", [["academy", "special"]]),
    ("Academy - Alternative Provision", [["academy", "alternative provision"], ["academy", "~ap"]]),
    ("Academy", [["academy"]]),
    ("Free School - Alternative Provision", [["free school", "alternative provision"]]),
    ("Free School - UTC", [["free school", "utc"], ["free school", "university technical college"]]),
    ("Free School - 16-19", [["free school", "16"], ["free school", "19"]]),
    ("Free School - Special", [["free school", "special"]]),
    ("Free School - Mainstream", [["free school"]]),
    ("Free School - UTC", [["university technical college"]]),
    ("Community Special School", [["community", "special"]]),
    ("Community School", [["community"]]),
    ("Foundation Special School", [["foundation", "special"]]),
    ("Foundation School", [["foundation"]]),
    ("Voluntary Aided School", [["voluntary aided"]]),
    ("Voluntary Controlled School", [["voluntary controlled"]]),
    ("Independent Special School", [["independent", "special"]]),
    ("Independent School", [["independent"]]),
    ("Non-Maintained Special School", [["non maintained"]]),
    ("Pupil Referral Unit", [["pupil referral"]]),
    ("Alternative Provision", [["alternative provision"]]),
    ("Further Education College", [["further education"], ["agriculture and horticulture college"]]),
]


def classify(value: Column, rules: Rules) -> Column:
    """The label of the first rule that fits the text in lower case with `-`, `_` and runs of spaces as one space; the trimmed text itself if none does."""
    text = F.regexp_replace(F.regexp_replace(F.lower(trimmed(value)), r"[\-_]+", " "), r"\s+", " ")

    def label_of(s: Column) -> Column:
        def test(word: str) -> Column:
            if word[0] == "=":
                return s == word[1:]
            if word[0] == "~":
                return F.regexp(s, F.lit(rf"\b{word[1:]}\b"))
            return ~F.contains(s, F.lit(word[1:])) if word[0] == "!" else F.contains(s, F.lit(word))

        out = F.when(F.lit(False), "")
        for label, ways in rules:
            out = out.when(reduce(Column.__or__, [reduce(Column.__and__, map(test, words)) for words in ways]), label)
        return out

    # within a lambda the text is a variable: read once, and out of the generated code, which would grow too large with it
    found = F.element_at(F.transform(F.array(text), label_of), 1)
    return F.when(value.isNotNull(), F.coalesce(found, trimmed(value)))
