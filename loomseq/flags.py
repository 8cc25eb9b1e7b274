"""Alignment flags: the twelve bits, as columns and as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the SAM format.
BITS = {
    "PAIRED": 0x1,
    "PROPER_PAIR": 0x2,
    "UNMAP": 0x4,
    "MUNMAP": 0x8,
    "REVERSE": 0x10,
    "MREVERSE": 0x20,
    "READ1": 0x40,
    "READ2": 0x80,
    "SECONDARY": 0x100,
    "QCFAIL": 0x200,
    "DUP": 0x400,
    "SUPPLEMENTARY": 0x800,
}
#: What depth, coverage, bed coverage and stepper ``all`` leave out.
EXCLUDED = BITS["UNMAP"] | BITS["SECONDARY"] | BITS["QCFAIL"] | BITS["DUP"]

#: Accessor name -> (bit, what the bit has to be).
ACCESSORS = {
    "is_paired": ("PAIRED", True),
    "is_proper_pair": ("PROPER_PAIR", True),
    "is_unmapped": ("UNMAP", True),
    "is_mapped": ("UNMAP", False),
    "mate_is_unmapped": ("MUNMAP", True),
    "mate_is_mapped": ("MUNMAP", False),
    "is_reverse": ("REVERSE", True),
    "is_forward": ("REVERSE", False),
    "mate_is_reverse": ("MREVERSE", True),
    "mate_is_forward": ("MREVERSE", False),
    "is_read1": ("READ1", True),
    "is_read2": ("READ2", True),
    "is_secondary": ("SECONDARY", True),
    "is_qcfail": ("QCFAIL", True),
    "is_duplicate": ("DUP", True),
    "is_supplementary": ("SUPPLEMENTARY", True),
}


def has(mask: int, flag: Column | str = "flag") -> Column:
    """All bits of the mask are set."""
    return (F.col(flag) if isinstance(flag, str) else flag).bitwiseAND(F.lit(mask)) == mask


def lacks(mask: int, flag: Column | str = "flag") -> Column:
    """No bit of the mask is set."""
    return (F.col(flag) if isinstance(flag, str) else flag).bitwiseAND(F.lit(mask)) == 0


def accessor(name: str, flag: Column | str = "flag") -> Column:
    bit, wanted = ACCESSORS[name]
    return has(BITS[bit], flag) if wanted else lacks(BITS[bit], flag)


def parse(text: str | int) -> int:
    """A flag from a number (decimal, 0x or 0 octal) or a comma-separated list of names."""
    if isinstance(text, int):
        return text
    value = 0
    for part in text.split(","):
        part = part.strip()
        if part.upper() in BITS:
            value |= BITS[part.upper()]
        elif part:
            value |= int(part, 8) if len(part) > 1 and part.isdigit() and part[0] == "0" else int(part, 0)
    return value


def names(flag: int) -> str:
    return ",".join(k for k, v in BITS.items() if flag & v)


def names_column(flag: Column | str = "flag") -> Column:
    """The comma-separated names of a flag column's bits."""
    return F.concat_ws(",", *(F.when(has(v, flag), k) for k, v in BITS.items()))
