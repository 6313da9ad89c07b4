"""Column expressions that turn compact encodings into dense vectors and back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cells import _col


def dense_from_sorted(entries, n: int) -> Column:
    """Dense ``array<bigint>`` of length ``n`` from an array of ``(pos, n)`` structs.

    The entries must be sorted by ``pos`` without repeats. Each one contributes the zeros
    of the gap before it and its own count, so the work is linear in ``n``. ``entries``
    has to be a plain column: it is read inside the lambda.
    """
    e = _col(entries)
    zero = F.lit(0).cast("bigint")

    def gap_and_count(x, i):
        before = F.when(i > 0, F.get(e, i - 1)["pos"]).otherwise(F.lit(-1))
        return F.concat(F.array_repeat(zero, x["pos"] - before - 1), F.array(x["n"]))

    last = F.coalesce(F.get(e, F.size(e) - 1)["pos"], F.lit(-1))
    tail = F.array_repeat(zero, F.lit(n - 1) - last)
    return F.concat(F.flatten(F.transform(e, gap_and_count)), tail)


def words_to_bitstring(words, n_bits: int) -> Column:
    """0/1 text of ``n_bits`` characters, bit 0 first, from an array of 64-bit words."""
    parts = F.transform(_col(words), lambda w: F.reverse(F.lpad(F.bin(w), 64, "0")))
    return F.substring(F.array_join(parts, ""), 1, n_bits)


# The eight bits of every byte, lowest first.
_BYTE_BITS = [[byte >> i & 1 for i in range(8)] for byte in range(256)]


def words_to_vector(words, n_bits: int) -> Column:
    """Dense ``array<int>`` of 0/1 from an array of 64-bit words.

    Works byte by byte through a table of bit patterns, as a lambda call per bit would cost
    more than everything before it. The words are only the argument of the outer call: an
    array read inside a lambda may be built anew for every element.
    """
    table = F.lit(_BYTE_BITS)

    def word_bits(word):
        byte = lambda i: F.shiftright(word, 8 * i).bitwiseAND(F.lit(255)).cast("int")
        return F.concat(*[F.get(table, byte(i)) for i in range(8)])

    bits = F.flatten(F.transform(_col(words), word_bits))
    return bits if n_bits % 64 == 0 else F.slice(bits, 1, n_bits)


def set_bits(words, n_bits: int) -> Column:
    """Ascending positions of the set bits."""
    return F.filter(
        F.transform(words_to_vector(words, n_bits), lambda b, i: F.when(b == 1, i)),
        lambda i: i.isNotNull(),
    )
