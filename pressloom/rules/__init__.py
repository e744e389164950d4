"""Rule packs: word lists and patterns as data, compiled into expressions at plan time."""

from pressloom.rules.pack import RulePack
from pressloom.rules.chinese import CHINESE
from pressloom.rules.latin import LATIN

__all__ = ["RulePack", "CHINESE", "LATIN"]
