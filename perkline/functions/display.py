"""Display texts and notification message templates (Column -> Column).

Rounding rules: kilometres show one decimal of the binary quotient, rounded
by its exact value, as number formatting does (350 m is a little under 0.35
and shows "0.3 km", 50 m a little over 0.05 and shows "0.1 km"); minutes are
rounded half-even.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from perkline.functions.text import col_

# ---------------------------------------------------------------------------
# FIXED VALUES — message texts that must equal the business reference.
# ---------------------------------------------------------------------------
TXT_DISTANCE_UNKNOWN = "distance inconnue"
TXT_DURATION_UNKNOWN = "durée inconnue"
TXT_DISTANCE_MISSING = "distance non renseignée"
# Templates per sport: {n} full name, {dist} distance text, {dur} duration
# text, {c} optional " (comment)".
TEMPLATES = {
    "Randonnée": "Magnifique {n} ! Une randonnée de {dist} terminée en {dur}, Félicitations !{c} 🏕",
    "Runing": "Bravo {n} ! Tu viens de courir {dist} en {dur} ! Belle énergie !{c} 🔥🏅",
    "Triathlon": "Fantastique {n} ! Performance haut niveau : {dur} sur {dist}. Endurance !{c} 🏅",
    "Natation": "Grandiose {n} ! Nager pendant {dur}, parcours {dist}. Comme un poisson !{c} 🔥",
}
TEMPLATE_DEFAULT = "Félicitations {n} ! Discipline {sport} pratiquée pendant {dur}. Bravo !{c} 🏅"


def display_km(distance_m: Column | str) -> Column:
    """``"x.y km"`` (one decimal) or ``distance inconnue``."""
    d = col_(distance_m)
    km = F.replace(F.format_number(d.cast("double") / F.lit(1000.0), 1), F.lit(","), F.lit(""))
    return F.when(d.isNull(), F.lit(TXT_DISTANCE_UNKNOWN)).otherwise(F.concat(km, F.lit(" km")))


def display_minutes(duration_sec: Column | str) -> Column:
    """``"n min"`` (minutes rounded half-even) or ``durée inconnue``."""
    s = col_(duration_sec)
    mins = F.bround(s.cast("decimal(20,0)") / F.lit(60), 0).cast("long")
    return F.when(s.isNull() | (s <= 0), F.lit(TXT_DURATION_UNKNOWN)).otherwise(F.concat(mins.cast("string"), F.lit(" min")))


def _fill(template: str, parts: dict[str, Column]) -> Column:
    """Concatenate a ``{name}`` template with column parts."""
    out, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        if head:
            out.append(F.lit(head))
        out.append(parts[name])
    if rest:
        out.append(F.lit(rest))
    return F.concat(*out)


def notification_text(first: Column | str, last: Column | str, sport: Column | str, dist_txt: Column | str,
                      dur_txt: Column | str, comment: Column | str) -> Column:
    """message for one activity, template chosen by the sport label."""
    full = F.trim(F.concat_ws(" ", F.coalesce(col_(first), F.lit("")), F.coalesce(col_(last), F.lit(""))))
    c = F.trim(F.coalesce(col_(comment), F.lit("")))
    c_txt = F.when(F.length(c) > 0, F.concat(F.lit(" ("), c, F.lit(")"))).otherwise(F.lit(""))
    dist = F.coalesce(F.when(F.length(col_(dist_txt)) > 0, col_(dist_txt)), F.lit(TXT_DISTANCE_MISSING))
    parts = {"n": full, "dist": dist, "dur": col_(dur_txt), "c": c_txt, "sport": F.coalesce(col_(sport), F.lit(""))}
    expr = None
    for label, tpl in TEMPLATES.items():
        branch = _fill(tpl, parts)
        expr = F.when(col_(sport) == label, branch) if expr is None else expr.when(col_(sport) == label, branch)
    return expr.otherwise(_fill(TEMPLATE_DEFAULT, parts))
