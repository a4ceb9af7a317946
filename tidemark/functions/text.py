"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode white-space character, the four separator
# controls U+001C to U+001F included.
WHITE_SPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f\u0020"
    "\u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
_CASED_OR_UNCASED_RUN = f"([{_CASED}]+|[^{_CASED}]+)"


def strip(text: Column) -> Column:
    """Without leading and trailing white space of any kind; NULL stays NULL.

    Each character at an end is looked up in all kinds, so where plain spaces
    alone surround visible ASCII characters these are taken off without.
    """
    plain = F.trim(text)
    visible = [end.between("!", "~") for end in (F.left(plain, F.lit(1)), F.right(plain, F.lit(1)))]
    return F.when(visible[0] & visible[1], plain).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def title_case(text: Column) -> Column:
    """Capital after anything that is not a letter, small letters elsewhere.

    ``initcap`` alone only starts a word at a space, so it is applied to each
    run of letters by itself.
    """
    runs = F.regexp_extract_all(text, F.lit(_CASED_OR_UNCASED_RUN), 1)
    return F.array_join(F.transform(runs, F.initcap), "")


def trailing_number(text: Column) -> Column:
    """The digits at the end as an integer; an error where there are none."""
    return F.regexp_extract(text, r"(\d+)$", 1).cast("int")
