"""Helpers that spell the fixed element table into oracle SQL text."""

from __future__ import annotations

from molspark.refdata import ELEMENT_VOCAB, element_ref_rows

HALOGENS = ("F", "Cl", "Br", "I")


def count_aggs(vocab=ELEMENT_VOCAB) -> str:
    parts = [f"CAST(count(*) FILTER (WHERE element = '{e}') AS BIGINT) AS n_{e}" for e in vocab]
    inlist = ", ".join(f"'{e}'" for e in vocab)
    parts.append("CAST(count(*) AS BIGINT) AS num_atoms")
    parts.append(f"CAST(count(*) FILTER (WHERE element IS NULL OR element NOT IN ({inlist})) "
                 "AS BIGINT) AS n_unsupported")
    return ",\n ".join(parts)


def hill_formula_sql(vocab=ELEMENT_VOCAB) -> str:
    def part(e):
        return (f"CASE WHEN n_{e} > 0 THEN '{e}' || CASE WHEN n_{e} > 1 THEN "
                f"CAST(n_{e} AS VARCHAR) ELSE '' END END")
    others = sorted(e for e in vocab if e not in ("C", "H"))
    with_c = ", ".join([part("C"), part("H")] + [part(e) for e in others])
    no_c = ", ".join(part(e) for e in sorted(vocab))
    return f"CASE WHEN n_C > 0 THEN concat_ws('', {with_c}) ELSE concat_ws('', {no_c}) END"


def combustion_parts(energy_index: int = 1):
    """(demand, products, hal, e_o2, reaction_terms) SQL snippets over n_<El>."""
    rows = element_ref_rows()
    hal = " + ".join(f"n_{h}" for h in HALOGENS)

    def neff(e):
        return f"(n_H - ({hal}))" if e == "H" else f"n_{e}"
    demand = " + ".join(f"{neff(r[1])} * {r[3]!r}" for r in rows)
    products = " + ".join(f"{neff(r[1])} * {r[4] * r[5 + energy_index]!r}"
                          for r in rows if r[5 + energy_index] is not None)
    e_o2 = [r for r in rows if r[1] == "O"][0][5 + energy_index]
    terms = ", ".join(
        f"CASE WHEN {neff(r[1])} * {r[4]!r} > 0 THEN printf('%.2f * %s', "
        f"{neff(r[1])} * {r[4]!r}, '{r[2]}') END" for r in rows)
    return demand, products, hal, e_o2, terms
