"""Decorators as objects: named tables in, key plus added columns out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimloom.functions import as_yes_no, holds
from claimloom.operators import attach, check_names, require_unique
from claimloom.plans.rule_sets import chosen_under
from claimloom.plans.rules import Rules
from claimloom.plans.surgery import (
    KEY,
    RESULT,
    chosen_lines,
    decorate,
    decoration_checks,
    is_eligible,
)
from claimloom.sources import publish

_MATCH = "_match"
_OF = "_of_"


def _one_per_key(tables: Sequence[DataFrame], key: str) -> DataFrame:
    """Tables with other columns each, in which a key comes once, as one such table."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    # each column has a key once, so there is one value to take
    return rows.groupBy(key).agg(*[F.max(c).alias(c) for c in rows.columns if c != key])


class LineDecorator:
    """Base to derive from: fill in ``_calc_decorator`` and the naming rule.

    A decorator that also fills in ``_line_columns``, ``_can_match`` and ``_chosen`` can be
    calculated together with others, see ``calc_decorators``.
    """

    key_fields: list[str] = [KEY]

    @staticmethod
    def validate_decor_column_name(name: str) -> bool:
        """Whether an added column may have this name."""
        raise NotImplementedError

    def _calc_decorator(
        self, dfs_input: Mapping[str, DataFrame], dfs_refs: Mapping[str, DataFrame], **kwargs
    ) -> DataFrame:
        raise NotImplementedError

    def _check_input(self, dfs_input: Mapping[str, DataFrame]) -> None:
        """Raise if the input breaks what the decoration relies on."""

    def _line_columns(self) -> dict[str, Column]:
        """Added columns that a line tells by itself."""
        raise NotImplementedError

    def _can_match(self) -> Column:
        """Whether a line may be among the chosen ones."""
        raise NotImplementedError

    def _chosen(
        self, dfs_input: Mapping[str, DataFrame], dfs_refs: Mapping[str, DataFrame]
    ) -> DataFrame:
        """The key and the other added columns, one row for each line that has them."""
        raise NotImplementedError

    @classmethod
    def _chosen_together(
        cls,
        decorators: Mapping[str, LineDecorator],
        dfs_input: Mapping[str, DataFrame],
        dfs_refs: Mapping[str, DataFrame],
    ) -> DataFrame:
        """What decorators of this class chose: the key and a struct under each one's name.

        A struct holds the columns that ``_chosen`` adds and is null where its decorator did not
        choose the line. A class whose decorators have work in common does it once here.
        """
        tables = []
        for name, decorator in decorators.items():
            (key,) = decorator.key_fields
            chosen = decorator._chosen(dfs_input, dfs_refs)
            check_names(chosen, [key], decorator.validate_decor_column_name)
            added = [c for c in chosen.columns if c != key]
            tables.append(chosen.select(key, F.struct(*added).alias(name)))
        return _one_per_key(tables, key)

    def calc_decorator(
        self,
        dfs_input: Mapping[str, DataFrame],
        dfs_refs: Mapping[str, DataFrame],
        check: bool = True,
        **kwargs,
    ) -> DataFrame:
        """The decoration, after a check of its input and its column names.

        ``check=False`` leaves out the check of the input, which runs a job.
        """
        if check:
            self._check_input(dfs_input)
        result = self._calc_decorator(dfs_input, dfs_refs, **kwargs)
        check_names(result, self.key_fields, self.validate_decor_column_name)
        return result

    def _checks(self) -> Mapping[str, Column]:
        """What must hold for every row of the result when it is published."""
        return {}

    def publish_decorator(
        self,
        dfs_input: Mapping[str, DataFrame],
        dfs_refs: Mapping[str, DataFrame],
        folder: str,
        lines: str = "outclaims",
        **kwargs,
    ) -> dict[str, int]:
        """Write the decoration below ``folder`` and publish it if it is right.

        The check is taken while the result is written and costs no job over the lines but a scan
        of their key: the result must hold each key of the table ``lines`` as often
        as that does. Returns what was counted; a result that breaks a rule is an error.
        """
        result = self.calc_decorator(dfs_input, dfs_refs, check=False, **kwargs)
        (key,) = self.key_fields
        return publish(result, folder, self._checks(), key, same_keys_as=dfs_input[lines])


class SurgeryDecorator(LineDecorator):
    """Decorates the table ``outclaims`` with the preventable surgery columns.

    With another ``prefix`` than ``psp_`` its columns stand beside those of other rules.
    """

    def __init__(self, rules: Rules = Rules(), prefix: str = "psp_"):
        self.rules = rules
        self.prefix = prefix
        if prefix != "psp_":
            self.validate_decor_column_name = lambda name: name.startswith(prefix)

    @staticmethod
    def validate_decor_column_name(name: str) -> bool:
        return name.startswith("psp_")

    def _named(self, name: str) -> str:
        return self.prefix + name.removeprefix("psp_")

    def _check_input(self, dfs_input):
        """Refuse lines whose key repeats; reads and shuffles the key column once."""
        require_unique(dfs_input["outclaims"], KEY)

    def _checks(self):
        return decoration_checks(self._named)

    def _line_columns(self):
        return {self._named(RESULT[1]): as_yes_no(is_eligible(self.rules))}

    def _can_match(self):
        return is_eligible(self.rules)

    def _chosen(self, dfs_input, dfs_refs):
        chosen = chosen_lines(dfs_input["outclaims"], dfs_refs, self.rules)
        return chosen.withColumnsRenamed({c: self._named(c) for c in RESULT[2:]})

    @classmethod
    def _chosen_together(cls, decorators, dfs_input, dfs_refs):
        """The lines are read once for all rule sets, see ``chosen_under``."""
        if len(decorators) == 1 or cls._chosen is not SurgeryDecorator._chosen:
            return super()._chosen_together(decorators, dfs_input, dfs_refs)
        rule_sets = {name: d.rules for name, d in decorators.items()}
        chosen = chosen_under(dfs_input["outclaims"], dfs_refs, rule_sets)

        def renamed(name: str, decorator: SurgeryDecorator) -> Column:
            fields = [F.col(name)[c].alias(decorator._named(c)) for c in RESULT[2:]]
            return F.when(F.col(name).isNotNull(), F.struct(*fields)).alias(name)

        return chosen.select(KEY, *[renamed(name, d) for name, d in decorators.items()])

    def _calc_decorator(self, dfs_input, dfs_refs, **kwargs):
        result = decorate(dfs_input["outclaims"], dfs_refs, self.rules)
        return result.withColumnsRenamed({c: self._named(c) for c in RESULT[1:]})


def calc_decorators(
    decorators: Sequence[LineDecorator],
    dfs_input: Mapping[str, DataFrame],
    dfs_refs: Mapping[str, DataFrame],
    lines: str = "outclaims",
    check: bool = True,
) -> DataFrame:
    """The columns of several decorators of one table, put back in one join.

    All have the same key, and no two add a column of the same name. The chosen lines of all
    are brought to one row per key, so the lines are shuffled once, however many decorators
    there are; the input is checked once for each kind of decorator, and what decorators of
    one kind have in common is calculated once.
    """
    keys = {tuple(d.key_fields) for d in decorators}
    if len(keys) != 1:
        raise ValueError(f"decorators with other keys or none at all: {sorted(keys)}")
    ((key,),) = keys
    kinds: dict[type[LineDecorator], dict[str, LineDecorator]] = {}
    for n, decorator in enumerate(decorators):
        kinds.setdefault(type(decorator), {})[f"{_OF}{n}"] = decorator
    if check:
        for alike in kinds.values():
            next(iter(alike.values()))._check_input(dfs_input)
    flags: dict[str, Column] = {}
    fields: dict[str, Column] = {}
    chosen: list[DataFrame] = []
    for kind, alike in kinds.items():
        chosen.append(kind._chosen_together(alike, dfs_input, dfs_refs))
        for name, decorator in alike.items():
            own = chosen[-1].select(f"{name}.*")
            check_names(own, [], decorator.validate_decor_column_name)
            line_columns = decorator._line_columns()
            if twice := sorted({*flags, *fields}.intersection([*line_columns, *own.columns])):
                raise ValueError(f"columns of two decorators: {', '.join(twice)}")
            flags |= line_columns
            fields |= {c: F.col(name)[c].alias(c) for c in own.columns}
    rows = chosen[0] if len(chosen) == 1 else _one_per_key(chosen, key)
    per_key = rows.select(key, *fields.values())
    match = reduce(or_, [holds(d._can_match()) for d in decorators])
    flagged = dfs_input[lines].select(
        key, match.alias(_MATCH), *[column.alias(name) for name, column in flags.items()]
    )
    return attach(flagged, per_key, key, F.col(_MATCH)).drop(_MATCH)
