from pyspark.sql import Column
from pyspark.sql import functions as F

# The accented letters that are folded, and the plain letter for each.
# Letters outside this list (ñ, ý, ...) stay as they are.
ACCENTED = "áàãâäéèêëíìîïóòõôöúùûüç"
PLAIN = "aaaaaeeeeiiiiooooouuuuc"
DIGITS = "0123456789"


def clean_city(city) -> Column:
    """Lower-case, fold accents, delete digits, strip outer spaces.

    ``translate`` deletes every character of its second argument that has no
    partner in the third, so folding and digit removal are one pass. Inner runs of
    spaces are kept, and a null stays null.
    """
    return F.trim(F.translate(F.lower(city), ACCENTED + DIGITS, PLAIN))
