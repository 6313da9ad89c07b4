"""Line notation to a graph inside one row, as Catalyst higher-order functions.

The notation is cut into tokens, and one fold over the tokens keeps the attach point, the
branch stack, the open rings and the bonds found so far. No chemistry is perceived beyond
what the text states: aromatic atoms are the lower-case ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cells import _col

# The chemical elements in order of atomic number, 1 to 118.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge "
    "As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm "
    "Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th "
    "Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og"
).split()

# Usual valences of the atoms that may be written without brackets.
VALENCES = {
    "B": (3,), "C": (4,), "N": (3, 5), "O": (2,), "P": (3, 5), "S": (2, 4, 6),
    "F": (1,), "Cl": (1,), "Br": (1,), "I": (1,),
}

# Bond order by bond symbol.
BOND_ORDERS = {"-": 1.0, "=": 2.0, "#": 3.0, "$": 4.0, ":": 1.5}

# Symbols that may be written in lower case for an aromatic atom.
AROMATIC = ("b", "c", "n", "o", "p", "s", "as", "se", "te")

# Longer symbols first, so that "Cl" is not read as "C".
_SYMBOL = "(?:" + "|".join(sorted((*ELEMENTS, *AROMATIC), key=len, reverse=True)) + r"|\*)"
_BRACKET = r"\[\d*" + _SYMBOL + r"@{0,2}(?:H\d*)?(?:[+-]+\d*)?(?::\d+)?\]"
TOKEN_PATTERN = _BRACKET + r"|Br|Cl|[BCNOPSFIbcnops*]|[-=#$:/\\]|[().]|%\d\d|\d"

_RINGS = "array<struct<num:int,atom:int,kind:string>>"


def tokens(notation) -> Column:
    """The tokens of the notation in order; characters outside the grammar are skipped."""
    return F.regexp_extract_all(_col(notation), F.lit(TOKEN_PATTERN), 0)


def atomic_number(symbol) -> Column:
    """Atomic number of an element symbol, null if it is unknown."""
    return F.nullif(F.array_position(F.lit(ELEMENTS), _col(symbol)).cast("int"), F.lit(0))


def bond_order(kind) -> Column:
    """Bond order of a bond symbol."""
    k = _col(kind)
    order = F.when(k == "-", F.lit(1.0))
    for symbol, value in list(BOND_ORDERS.items())[1:]:
        order = order.when(k == symbol, F.lit(value))
    return order


def _classify(token: Column) -> Column:
    """Token as ``(t, num, kind)``: atom ``a``, ring ``r``, bond ``b``, or the sign itself.

    ``num`` is the ring number, or 1 for an aromatic atom.
    """
    first = F.substring(token, 1, 1)
    aromatic = F.when(first == "[", token.rlike(r"^\[\d*[a-z]")).otherwise(first >= "a")

    def token_of(t, num=None, kind=None):
        return F.struct(
            F.lit(t).alias("t"),
            (F.lit(None) if num is None else num).cast("int").alias("num"),
            (F.lit(None) if kind is None else kind).cast("string").alias("kind"),
        )

    return (
        F.when(first.isin("(", ")", "."), token_of(first))
        .when(first.isin("-", "=", "#", "$", ":", "/", "\\"),
              token_of("b", kind=F.translate(token, "/\\", "--")))
        .when((first <= "9") & (first != "*"), token_of("r", num=F.ltrim(token, F.lit("%"))))
        .otherwise(token_of("a", num=aromatic))
    )


def _fold(s: Column, x: Column) -> Column:
    t = x["t"]
    no_kind = s["kind"] == ""
    attached = s["prev"] >= 0
    same_ring = lambda r: r["num"] == x["num"]
    # An attach point is coded as twice its index, plus one if the atom is aromatic.
    here = s["n"] * 2 + x["num"]

    def state(**changes):
        """The state with some fields replaced; the others are passed on untouched."""
        names = ("n", "prev", "stack", "rings", "kind", "bonds", "ok")
        return F.struct(*[changes.get(f, s[f]).alias(f) for f in names])

    def bond(a, b, kind):
        # Bonds grow as text: the fold copies its state at every token, and a text is one
        # block of bytes where an array of structs is not.
        default = F.when(a.bitwiseAND(b).bitwiseAND(F.lit(1)) == 1, ":").otherwise("-")
        index = lambda c: F.shiftright(c, 1).cast("string")
        return F.concat(
            s["bonds"],
            index(F.least(a, b)), F.lit(","), index(F.greatest(a, b)), F.lit(","),
            F.when(kind == "", default).otherwise(kind), F.lit(";"),
        )

    def ring_end():
        hit = F.get(F.filter(s["rings"], same_ring), F.lit(0))
        kind = F.when(no_kind, hit["kind"]).otherwise(s["kind"])
        return state(
            rings=F.filter(s["rings"], lambda r: r["num"] != x["num"]),
            kind=F.lit(""),
            bonds=bond(hit["atom"], s["prev"], kind),
            ok=s["ok"] & attached & (hit["atom"] != s["prev"]),
        )

    ring = F.struct(x["num"].alias("num"), s["prev"].alias("atom"), s["kind"].alias("kind"))
    depth = F.size(s["stack"])
    return (
        F.when((t == "a") & attached, state(
            n=s["n"] + 1, prev=here, kind=F.lit(""), bonds=bond(s["prev"], here, s["kind"])
        ))
        .when(t == "a", state(n=s["n"] + 1, prev=here, kind=F.lit("")))
        .when(t == "b", state(kind=x["kind"], ok=s["ok"] & attached & no_kind))
        .when(t == "(", state(
            stack=F.concat(s["stack"], F.array(s["prev"])), ok=s["ok"] & attached & no_kind
        ))
        .when((t == ")") & (depth > 0), state(
            prev=F.get(s["stack"], depth - 1),
            stack=F.slice(s["stack"], 1, depth - 1),
            ok=s["ok"] & no_kind,
        ))
        .when(t == ")", state(ok=F.lit(False)))
        .when(t == ".", state(prev=F.lit(-1), ok=s["ok"] & attached & no_kind))
        .when(F.exists(s["rings"], same_ring), ring_end())
        .otherwise(state(
            rings=F.concat(s["rings"], F.array(ring)), kind=F.lit(""), ok=s["ok"] & attached
        ))
    )


def fold_bonds(token_array) -> Column:
    """State after the last token: atom count, bonds, and what was left open."""
    start = F.struct(
        F.lit(0).alias("n"),
        F.lit(-1).alias("prev"),
        F.array().cast("array<int>").alias("stack"),
        F.array().cast(_RINGS).alias("rings"),
        F.lit("").alias("kind"),
        F.lit("").alias("bonds"),
        F.lit(True).alias("ok"),
    )
    return F.aggregate(F.transform(_col(token_array), _classify), start, _fold)


def with_graph(df, col: str, atoms_as: str = "atoms", bonds_as: str = "bonds", error_as: str = "error"):
    """Add the atom tokens and the bonds of the notation in ``col``, or why it is invalid.

    Bonds are texts ``a,b,kind`` with ``a < b``. Both arrays are null where ``error`` is
    set. Bonds without a mark are aromatic between two aromatic atoms and single otherwise.
    """
    t, s, b = "__tokens", "__state", "__bonds"
    out = (
        df.withColumn(t, tokens(col))
        .withColumn(s, fold_bonds(t))
        .withColumn(b, F.split(F.rtrim(F.col(s)["bonds"], F.lit(";")), ";"))
    )
    state = F.col(s)
    # Only a ring mark can name a pair of atoms that is bonded already.
    pairs = F.transform(F.col(b), lambda x: F.substring_index(x, ",", 2))
    error = (
        F.when(F.col(col).isNull() | (F.col(col) == ""), "empty notation")
        .when(F.array_join(F.col(t), "") != F.col(col), "unknown token")
        .when(F.size(state["rings"]) > 0, "unclosed ring")
        .when((F.size(state["stack"]) > 0) | F.col(col).contains("()"), "unbalanced branch")
        .when(~state["ok"] | (state["kind"] != ""), "misplaced branch, bond or ring mark")
        .when(
            F.col(col).rlike(r"\d") & (F.size(F.array_distinct(pairs)) != F.size(F.col(b))),
            "repeated bond",
        )
    )
    none = F.array().cast("array<string>")
    is_atom = lambda x: x.rlike(r"^[\[A-Za-z*]")
    return (
        out.withColumn(error_as, error)
        .withColumn(bonds_as, F.when(
            F.col(error_as).isNull(), F.when(state["bonds"] == "", none).otherwise(F.col(b))
        ))
        .withColumn(atoms_as, F.when(F.col(error_as).isNull(), F.filter(F.col(t), is_atom)))
        .drop(t, s, b)
    )


def atom_fields(token) -> dict[str, Column]:
    """Fields of one atom token: label, charge, explicit hydrogens, aromatic flag.

    ``explicit_h`` is null for atoms written without brackets: their hydrogens follow from
    the usual valences.
    """
    token = _col(token)
    bracket = token.startswith("[")
    symbol = F.when(
        bracket, F.regexp_extract(token, r"^\[\d*(" + _SYMBOL + ")", 1)
    ).otherwise(token)
    hydrogens = F.regexp_extract(token, r"^\[\d*" + _SYMBOL + r"@{0,2}(H\d*)", 1)
    sign = F.regexp_extract(token, r"([+-]+\d*)(?::\d+)?\]$", 1)
    digits = F.regexp_extract(sign, r"(\d+)$", 1)
    size = F.when(digits != "", digits.try_cast("int")).otherwise(F.length(sign))
    return {
        "label": F.initcap(symbol),
        "charge": F.when(~bracket, 0).when(sign.startswith("-"), -size).otherwise(size),
        "explicit_h": F.when(bracket & (hydrogens == ""), 0)
        .when(bracket & (hydrogens == "H"), 1)
        .when(bracket, F.substring(hydrogens, 2, 9).try_cast("int")),
        "aromatic": symbol.rlike("^[a-z]"),
    }
