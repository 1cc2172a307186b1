"""Word tables for the sentiment score."""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from typing import ClassVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A lexicon up to this many words is carried inside the query as a literal; a larger one is
# joined as a table (see functions.sentiment.score_with_table).
MAX_INLINE_WORDS = 50_000

# The step a booster word adds or takes.
BOOST = 0.293


@dataclass(frozen=True)
class Lexicon:
    """``words``: valence per word; ``boosters``: signed step per word; ``negators``: words."""

    SLOT_TYPE: ClassVar[str] = "array<map<string,struct<v:double,b:double,n:boolean>>>"

    words: Mapping[str, float]
    boosters: Mapping[str, float] = field(default_factory=dict)
    negators: frozenset[str] = frozenset()

    def __post_init__(self) -> None:
        if len(self.vocabulary()) > MAX_INLINE_WORDS:
            raise ValueError(f"over {MAX_INLINE_WORDS} words: use score_with_table")

    def vocabulary(self) -> set[str]:
        return {*self.words, *self.boosters, *self.negators}

    @classmethod
    def of(cls, words: Mapping[str, float], boosters: Mapping[str, float] | None = None,
           negators: Iterable[str] = ()) -> "Lexicon":
        return cls(dict(words), dict(boosters or {}), frozenset(negators))

    @classmethod
    def from_table(cls, table: DataFrame) -> "Lexicon":
        """Read a (word, valence, boost, negates) table, refusing one too large to inline."""
        rows = table.select("word", "valence", "boost", "negates").limit(MAX_INLINE_WORDS + 1).collect()
        if len(rows) > MAX_INLINE_WORDS:
            raise ValueError(f"over {MAX_INLINE_WORDS} words: use score_with_table")
        return cls.of(
            {r.word: r.valence for r in rows if r.valence is not None},
            {r.word: r.boost for r in rows if r.boost is not None},
            [r.word for r in rows if r.negates],
        )

    @classmethod
    def from_file(cls, spark: SparkSession, path: str, boosters: Mapping[str, float] | None = None,
                  negators: Iterable[str] | None = None) -> "Lexicon":
        """Read tab-separated lines of word, valence and anything else, the usual form of published
        lexicons. Boosters and negators default to those of ``english``."""
        lines = spark.read.option("sep", "\t").option("quote", "").schema("word string, valence double").csv(path)
        known = lines.where("word is not null and valence is not null").limit(MAX_INLINE_WORDS + 1).collect()
        if len(known) > MAX_INLINE_WORDS:
            raise ValueError(f"over {MAX_INLINE_WORDS} words: use score_with_table")
        usual = english()
        return cls.of({r.word: r.valence for r in known},
                      usual.boosters if boosters is None else boosters,
                      usual.negators if negators is None else negators)

    def rows(self) -> list[tuple]:
        return [
            (w, self.words.get(w), self.boosters.get(w), w in self.negators)
            for w in sorted(self.vocabulary())
        ]

    def size(self) -> int:
        return max(1, len(self.vocabulary()))

    def slots(self) -> list[dict]:
        """The words in small maps, addressed by a checksum of the word."""
        out: list[dict] = [{} for _ in range(self.size())]
        for word, valence, boost, negates in self.rows():
            out[zlib.crc32(word.encode()) % self.size()][word] = {"v": valence, "b": boost, "n": negates}
        return out

    def finder(self) -> Callable[[Column], Column]:
        """A function from a word column to struct(v, b, n), null for unknown words.

        The slots are one constant of the query, so a look-up costs the same whatever the size
        of the lexicon.
        """
        table = F.from_json(F.lit(json.dumps(self.slots())), self.SLOT_TYPE)

        def find(word: Column) -> Column:
            slot = F.pmod(F.crc32(word.cast("binary")), F.lit(self.size())).cast("int")
            return F.try_element_at(F.get(table, slot), word)

        return find


def english() -> Lexicon:
    """A small hand-written starting lexicon for market talk; pass your own for real use."""
    strong_up = "amazing awesome excellent fantastic love outstanding perfect superb wonderful best"
    up = ("good great gain gains bullish happy win wins strong profit profits growth buy success "
          "impressive beat beats rally soar soars surge boost upgrade like nice hope winning")
    strong_down = "awful disaster fraud hate horrible terrible worst crash catastrophe scam"
    down = ("bad loss losses bearish sad weak drop drops fall falls sell fail fails failure miss "
            "misses decline lawsuit risk fear debt downgrade problem slump wrong losing")
    more = "very really extremely absolutely incredibly totally highly hugely especially so"
    less = "slightly barely hardly somewhat marginally partly almost"
    words = {
        **dict.fromkeys(strong_up.split(), 3.0), **dict.fromkeys(up.split(), 1.8),
        **dict.fromkeys(strong_down.split(), -3.0), **dict.fromkeys(down.split(), -1.8),
    }
    boosters = {**dict.fromkeys(more.split(), BOOST), **dict.fromkeys(less.split(), -BOOST)}
    negators = ("not no never none cannot without neither nor don't doesn't didn't isn't wasn't "
                "won't can't couldn't shouldn't wouldn't aren't weren't nothing").split()
    return Lexicon.of(words, boosters, negators)
