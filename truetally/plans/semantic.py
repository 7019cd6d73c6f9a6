"""Semantic model: entities, N:1 relationships, facts, dimensions, metrics.

``SemanticModel.query`` compiles a metric request into an ordinary DataFrame
plan: row scope on the home fact -> left joins to the dimension entities it
needs (N:1 only, so no fan-out) -> filters -> groupBy/agg. Names are resolved
in Python against the declared model; Catalyst does the rest (pruning,
pushdown, join strategy).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truetally.functions.calendar import fiscal_quarter_label, period_bounds, quarter_label
from truetally.functions.units import ratio
from truetally.operators.security import apply_mask, apply_row_scope
from truetally.params import DEFAULT_AS_OF
from truetally.plans.conform import SORT_ANCHOR, in_years


@dataclass(frozen=True)
class Entity:
    name: str
    table: str  # attribute of Conformed
    pk: str
    synonyms: tuple[str, ...] = ()
    comment: str = ""
    is_fact: bool = False


@dataclass(frozen=True)
class Relationship:
    name: str
    src: str
    fk: str
    dst: str


@dataclass(frozen=True)
class Dimension:
    entity: str
    name: str
    column: str
    synonyms: tuple[str, ...] = ()
    comment: str = ""
    grain: str | None = None  # of a date: a label of GRAINS instead of the date itself

    def expr(self) -> Column:
        return GRAINS[self.grain](self.column) if self.grain else F.col(self.column)


#: Labels of a date dimension, asked for as ``<dimension>.<grain>`` and returned as ``<dimension>_<grain>``.
GRAINS = {"month": lambda c: F.trunc(c, "month"), "quarter": quarter_label, "fiscal_quarter": fiscal_quarter_label,
          "year": lambda c: F.year(c)}


@dataclass(frozen=True)
class Fact:
    entity: str
    name: str
    column: str


@dataclass(frozen=True)
class Metric:
    entity: str
    name: str
    kind: str  # sum | ratio | avg
    num: str
    den: str | None = None
    out_type: str = "double"
    anchor: str | None = None
    synonyms: tuple[str, ...] = ()
    comment: str = ""
    last_over: str | None = None  # semi-additive: not summed over this date column, the last date of a group counts

    def partials(self, where: Column | None = None, name: str | None = None) -> list[tuple[str, Column]]:
        """Additive partial aggregates (name, expr) -- mergeable per fact; ``where``: over those rows alone."""
        name = name or self.name
        of = lambda c: F.col(c) if where is None else F.when(where, F.col(c))
        if self.kind == "sum":
            return [(f"{name}__n", F.sum(of(self.num)))]
        if self.kind == "ratio":
            return [(f"{name}__n", F.sum(of(self.num))), (f"{name}__d", F.sum(of(self.den)))]
        if self.kind == "avg":
            return [(f"{name}__n", F.sum(of(self.num))), (f"{name}__d", F.count(of(self.num)))]
        raise ValueError(self.kind)

    def merge(self) -> list[Column]:
        """Re-aggregate partials (sums of sums, sums of counts)."""
        names = [f"{self.name}__n"] + ([] if self.kind == "sum" else [f"{self.name}__d"])
        return [F.sum(n).alias(n) for n in names]

    def final(self, name: str | None = None) -> Column:
        n, d = F.col(f"{name or self.name}__n"), F.col(f"{name or self.name}__d")
        if self.kind == "sum":
            return n.cast(self.out_type)
        return ratio(n, d)


def _syn(*s):
    return tuple(s)


# The declared model (names, keys, edges, synonyms) of the
# governed layer; the comments are our own.
ENTITIES = [
    Entity("suppliers", "dim_supplier", "supplier_id", _syn("vendors", "vendor", "sources of supply"),
           "One row per real-world supplier"),
    Entity("parts", "dim_part", "part_id", _syn("materials", "components", "SKUs", "items"),
           "Material master, by commodity and category"),
    Entity("plants", "dim_plant", "plant_id", _syn("sites", "factories", "locations", "facilities"),
           "Manufacturing sites, by region and country"),
    Entity("customers", "dim_customer", "customer_id", _syn("dealers", "buyers", "accounts"), "Who orders"),
    Entity("carriers", "dim_carrier", "carrier_id",
           _syn("transporters", "logistics providers", "3PLs", "shipping partners"), "Companies that carry outbound legs"),
    Entity("po_lines", "fct_po_line", "po_line_id",
           _syn("purchase order lines", "inbound receipts", "supplier deliveries", "POs"),
           "What was bought: dates, receipts, cost parts per PO line", is_fact=True),
    Entity("order_lines", "fct_order_line", "order_line_id",
           _syn("sales order lines", "customer orders", "demand lines"),
           "What was sold: promise, shipped and delivered per line", is_fact=True),
    Entity("shipments", "fct_shipment", "shipment_id", _syn("outbound shipments", "consignments", "dispatches"),
           "Each outbound leg", is_fact=True),
    Entity("inventory", "fct_inventory", "inventory_position_id", _syn("stock", "inventory position", "on hand"),
           "Stock positions at month end, per plant and part", is_fact=True),
]

RELATIONSHIPS = [
    Relationship("po_to_supplier", "po_lines", "supplier_id", "suppliers"),
    Relationship("po_to_part", "po_lines", "part_id", "parts"),
    Relationship("po_to_plant", "po_lines", "plant_id", "plants"),
    Relationship("order_to_customer", "order_lines", "customer_id", "customers"),
    Relationship("order_to_part", "order_lines", "part_id", "parts"),
    Relationship("order_to_plant", "order_lines", "plant_id", "plants"),
    Relationship("order_to_carrier", "order_lines", "primary_carrier_id", "carriers"),
    Relationship("shipment_to_customer", "shipments", "customer_id", "customers"),
    Relationship("shipment_to_part", "shipments", "part_id", "parts"),
    Relationship("shipment_to_plant", "shipments", "plant_id", "plants"),
    Relationship("shipment_to_carrier", "shipments", "carrier_id", "carriers"),
    Relationship("inventory_to_part", "inventory", "part_id", "parts"),
    Relationship("inventory_to_plant", "inventory", "plant_id", "plants"),
]

FACTS = [Fact(*x) for x in (  # (entity, fact name, column)
    ("po_lines", "po_order_qty_ea", "order_qty_ea"), ("po_lines", "po_received_qty_ea", "received_qty_ea"),
    ("po_lines", "po_due_line_flag", "due_line_flag"), ("po_lines", "po_on_time_line_flag", "on_time_line_flag"),
    ("po_lines", "po_days_late", "days_late"), ("po_lines", "po_unit_price_usd", "unit_price_usd"),
    ("po_lines", "po_goods_value_usd", "goods_value_usd"), ("po_lines", "po_freight_usd", "freight_usd"),
    ("po_lines", "po_duty_usd", "duty_usd"), ("po_lines", "po_insurance_usd", "insurance_usd"),
    ("po_lines", "po_handling_usd", "handling_usd"), ("po_lines", "po_landed_cost_usd", "landed_cost_usd"),
    ("order_lines", "so_order_qty_ea", "order_qty_ea"), ("order_lines", "so_due_line_flag", "due_line_flag"),
    ("order_lines", "so_due_order_qty_ea", "due_order_qty_ea"),
    ("order_lines", "so_due_shipped_by_commit_qty_ea", "due_shipped_by_commit_qty_ea"),
    ("order_lines", "so_due_line_filled_flag", "due_line_filled_flag"),
    ("order_lines", "so_due_line_on_time_flag", "due_line_on_time_flag"),
    ("order_lines", "so_order_value_usd", "order_value_usd"),
    ("shipments", "shp_shipped_qty_ea", "shipped_qty_ea"), ("shipments", "shp_freight_cost_usd", "freight_cost_usd"),
    ("shipments", "shp_transit_days", "transit_days"), ("shipments", "shp_gross_weight_kg", "gross_weight_kg"),
    ("inventory", "inv_on_hand_qty_ea", "on_hand_qty_ea"), ("inventory", "inv_value_usd", "inventory_value_usd"),
    ("inventory", "inv_in_transit_value_usd", "in_transit_value_usd"),
    ("inventory", "inv_avg_daily_cogs_usd", "avg_daily_cogs_usd"),
)]

DIMENSIONS = [
    Dimension("suppliers", "supplier_name", "supplier_name", _syn("vendor name")),
    Dimension("suppliers", "supplier_country", "supplier_country", _syn("origin country", "vendor country")),
    Dimension("suppliers", "supplier_tier", "supplier_tier", _syn("tier")),
    Dimension("parts", "part_id", "part_id", _syn("material number", "part number", "SKU")),
    Dimension("parts", "part_name", "part_name", _syn("material description")),
    Dimension("parts", "commodity", "commodity", _syn("commodity group", "spend category")),
    Dimension("parts", "part_category", "part_category", _syn("category", "product family")),
    Dimension("plants", "plant_id", "plant_id", _syn("plant code", "site code")),
    Dimension("plants", "plant_name", "plant_name", _syn("plant", "factory name")),
    Dimension("plants", "plant_city", "plant_city", _syn("city", "location"), "Filter plants by city"),
    Dimension("plants", "plant_country", "plant_country", _syn("country")),
    Dimension("plants", "plant_region", "plant_region", _syn("region")),
    Dimension("customers", "customer_name", "customer_name", _syn("dealer name", "account name")),
    Dimension("customers", "customer_country", "customer_country"),
    Dimension("customers", "customer_segment", "customer_segment", _syn("channel", "customer type")),
    Dimension("carriers", "carrier_name", "carrier_name", _syn("transporter", "logistics provider")),
    Dimension("carriers", "transport_mode", "transport_mode", _syn("mode")),
    Dimension("po_lines", "po_number", "po_number", _syn("purchase order number")),
    Dimension("po_lines", "po_date", "po_date", _syn("order placed date")),
    Dimension("po_lines", "confirmed_date", "confirmed_date",
              _syn("supplier confirmed date", "promised date", "inbound due date"), "Time anchor for supplier_otd"),
    Dimension("po_lines", "confirmed_month", "confirmed_month"),
    Dimension("po_lines", "confirmed_quarter", "confirmed_quarter"),
    Dimension("po_lines", "confirmed_fiscal_quarter", "confirmed_fiscal_quarter"),
    Dimension("po_lines", "receipt_date", "receipt_date", _syn("received date", "arrival date"),
              "Time anchor for landed cost"),
    Dimension("po_lines", "receipt_quarter", "receipt_quarter"),
    Dimension("po_lines", "delivery_status", "delivery_status"),
    Dimension("po_lines", "arrival_source", "arrival_source"),
    Dimension("po_lines", "confirmed_date_source", "confirmed_date_source"),
    Dimension("order_lines", "sales_order_number", "sales_order_number"),
    Dimension("order_lines", "order_date", "order_date"),
    Dimension("order_lines", "commit_date", "commit_date", _syn("committed date", "promise date", "customer due date"),
              "Time anchor for customer_otd and fill rates"),
    Dimension("order_lines", "commit_month", "commit_month"),
    Dimension("order_lines", "commit_quarter", "commit_quarter"),
    Dimension("order_lines", "commit_fiscal_quarter", "commit_fiscal_quarter"),
    Dimension("order_lines", "line_status", "line_status"),
    Dimension("shipments", "ship_date", "ship_date", _syn("dispatch date")),
    Dimension("shipments", "ship_month", "ship_month"),
    Dimension("shipments", "delivery_date", "delivery_date", _syn("POD date")),
    Dimension("shipments", "shipment_status", "shipment_status"),
    Dimension("inventory", "snapshot_date", "snapshot_date", (), "Time anchor for days_of_inventory"),
    Dimension("inventory", "snapshot_month", "snapshot_month"),
    Dimension("inventory", "is_latest_snapshot", "is_latest_snapshot"),
]

M2, M3, L = "decimal(38,2)", "decimal(38,3)", "bigint"
METRICS = [
    Metric("po_lines", "supplier_otd", "ratio", "on_time_line_flag", "due_line_flag", anchor="confirmed_date",
           synonyms=_syn("supplier on-time delivery", "inbound OTD", "vendor OTD", "vendor on-time delivery",
                         "supplier delivery performance")),
    Metric("po_lines", "due_po_lines", "sum", "due_line_flag", out_type=L, anchor="confirmed_date"),
    Metric("po_lines", "avg_days_late", "avg", "days_late", anchor="confirmed_date"),
    Metric("po_lines", "total_landed_cost_usd", "sum", "landed_cost_usd", out_type=M2, anchor="receipt_date",
           synonyms=_syn("landed cost", "all-in cost", "total cost of acquisition")),
    Metric("po_lines", "landed_cost_per_unit_usd", "ratio", "landed_cost_usd", "received_qty_ea",
           anchor="receipt_date", synonyms=_syn("unit landed cost")),
    Metric("po_lines", "total_goods_value_usd", "sum", "goods_value_usd", out_type=M2,
           synonyms=_syn("purchase value", "spend")),
    Metric("order_lines", "customer_otd", "ratio", "due_line_on_time_flag", "due_line_flag", anchor="commit_date",
           synonyms=_syn("customer on-time delivery", "outbound OTD", "delivery to promise")),
    Metric("order_lines", "unit_fill_rate", "ratio", "due_shipped_by_commit_qty_ea", "due_order_qty_ea",
           anchor="commit_date", synonyms=_syn("fill rate", "unit fill")),
    Metric("order_lines", "line_fill_rate", "ratio", "due_line_filled_flag", "due_line_flag", anchor="commit_date",
           synonyms=_syn("line fill")),
    Metric("order_lines", "ordered_units", "sum", "order_qty_ea", out_type=M3),
    Metric("order_lines", "total_order_value_usd", "sum", "order_value_usd", out_type=M2,
           synonyms=_syn("sales value", "order intake")),
    Metric("shipments", "total_outbound_freight_usd", "sum", "freight_cost_usd", out_type=M2,
           synonyms=_syn("freight cost", "transport cost")),
    Metric("shipments", "avg_transit_days", "avg", "transit_days", synonyms=_syn("transit time", "lead time in transit")),
    Metric("shipments", "shipped_units", "sum", "shipped_qty_ea", out_type=M3),
    Metric("inventory", "days_of_inventory", "ratio", "inventory_value_usd", "avg_daily_cogs_usd",
           anchor="snapshot_date", last_over="snapshot_date",
           synonyms=_syn("DOI", "days of supply", "days on hand", "inventory days", "days of stock")),
    Metric("inventory", "total_inventory_value_usd", "sum", "inventory_value_usd", out_type=M2,
           anchor="snapshot_date", last_over="snapshot_date", synonyms=_syn("stock value", "inventory value")),
]

# A bare "OTD"/"on-time delivery" is ambiguous between inbound and outbound.
AMBIGUOUS_TERMS = ("otd", "on-time delivery", "on time delivery", "delivery performance")

Filter = tuple  # (dimension, op, value)


class SemanticError(ValueError):
    pass


@dataclass
class SemanticModel:
    entities: list[Entity] = field(default_factory=lambda: list(ENTITIES))
    relationships: list[Relationship] = field(default_factory=lambda: list(RELATIONSHIPS))
    dimensions: list[Dimension] = field(default_factory=lambda: list(DIMENSIONS))
    metrics: list[Metric] = field(default_factory=lambda: list(METRICS))
    facts: list[Fact] = field(default_factory=lambda: list(FACTS))

    def entity(self, name: str) -> Entity:
        return next(e for e in self.entities if e.name == name)

    def metric(self, name: str) -> Metric:
        for m in self.metrics:
            if m.name == name or f"{m.entity}.{m.name}" == name:
                return m
        raise SemanticError(f"unknown metric {name!r}")

    def dimension(self, name: str) -> Dimension:
        for d in self.dimensions:
            if d.name == name or f"{d.entity}.{d.name}" == name:
                return d
        base, _, grain = name.rpartition(".")
        if grain in GRAINS and base:
            d = self.dimension(base)
            return replace(d, name=f"{d.name}_{grain}", grain=grain)
        raise SemanticError(f"unknown dimension {name!r}")

    def fact(self, name: str) -> Fact:
        for f in self.facts:
            if f.name == name or f"{f.entity}.{f.name}" == name:
                return f
        raise SemanticError(f"unknown fact {name!r}")

    def attribute(self, name: str) -> Dimension:
        """What a filter names: a dimension, or a fact of its rows."""
        try:
            return self.dimension(name)
        except SemanticError:
            f = self.fact(name)
            return Dimension(f.entity, f.name, f.column)

    def own_column(self, fact: str, d: Dimension) -> Column | None:
        """``d`` as a column of the fact's table: its own attribute, or another entity's key, which is the fact's
        foreign key (in labels and filters alike, so a key that the entity lacks is a group of its own). None: the
        entity has to be joined."""
        if d.entity == fact:
            return d.expr()
        rel, ent = self.edge(fact, d.entity), self.entity(d.entity)
        return F.col(rel.fk) if d.column == ent.pk and not d.grain else None

    def edge(self, src: str, dst: str) -> Relationship:
        for r in self.relationships:
            if r.src == src and r.dst == dst:
                return r
        raise SemanticError(f"{dst} is not reachable N:1 from {src} (no declared relationship)")

    # ------------------------------------------------------------------ query
    def _fact_frame(self, conformed, fact: str, filters, role, scope) -> DataFrame:
        """Home fact, row-scoped and masked, with every filter applied: filters
        on the fact's own columns directly, filters on another entity as a
        semi join with that entity's filtered keys (all operators reject NULL,
        so this equals filtering after a left join)."""
        df = getattr(conformed, self.entity(fact).table)
        if scope is not None:
            df = apply_row_scope(df, scope, role)
        df = apply_mask(df, role)
        elsewhere: dict[str, list[Column]] = {}
        for name, op, value in filters:
            d = self.attribute(name)
            own = self.own_column(fact, d)
            if own is None:
                elsewhere.setdefault(d.entity, []).append(_predicate(d.expr(), op, value))
                continue
            df = df.filter(_predicate(own, op, value))
            if d.entity == fact and not d.grain and op in ("range", "between") and d.column == SORT_ANCHOR.get(self.entity(fact).table):
                df = in_years(df, *value)
        for entity, predicates in elsewhere.items():  # all filters on one entity make one semi join
            rel, ent = self.edge(fact, entity), self.entity(entity)
            keys = getattr(conformed, ent.table)
            for p in predicates:
                keys = keys.filter(p)
            keys = keys.select(F.col(ent.pk).alias("__k"))
            df = df.join(keys, df[rel.fk] == keys["__k"], "left_semi")
        return df

    def _joined(self, conformed, fact: str, df: DataFrame, dims: Sequence[Dimension]) -> DataFrame:
        """``df`` (with ``__fk_<entity>`` columns) left-joined to the entities of ``dims``, whose labels it gets."""
        other: dict[str, list[Dimension]] = {}
        for d in dims:
            if self.own_column(fact, d) is None:
                other.setdefault(d.entity, []).append(d)
        for ent_name, ds in other.items():
            ent = self.entity(ent_name)
            right = getattr(conformed, ent.table).select(F.col(ent.pk).alias(f"__pk_{ent_name}"),
                                                         *[d.expr().alias(d.name) for d in ds])
            df = df.join(right, df[f"__fk_{ent_name}"] == right[f"__pk_{ent_name}"], "left")
        return df

    def _keys(self, fact: str, dims: Sequence[Dimension]) -> list[Column]:
        """Columns of the fact's table that ``dims`` need: own labels, and foreign keys of entities to be joined."""
        own = [(d, self.own_column(fact, d)) for d in dims]
        fks = dict.fromkeys(d.entity for d, c in own if c is None)
        return [c.alias(d.name) for d, c in own if c is not None] + [
            F.col(self.edge(fact, e).fk).alias(f"__fk_{e}") for e in fks]

    def _aggregate(self, conformed, fact: str, df: DataFrame, dims: Sequence[Dimension],
                   metrics: Sequence[Metric], last_over: str | None = None) -> DataFrame:
        """Aggregate below the dimension joins: partials are first summed per
        (fact-own dimensions, foreign keys) -- map-side combined, so a hot key
        becomes one row -- then the few pre-aggregated rows are left-joined to
        the dimension entities and re-summed per dimension value.

        ``last_over``: the partials are kept apart by this date, too, and of each
        group those of its last date are taken (``max_by``, combined map-side)."""
        date = [F.col(last_over).alias("__at")] if last_over else []
        group = [*self._keys(fact, dims), *date]
        partials = [e.alias(n) for m in metrics for n, e in m.partials()]
        out = df.groupBy(*group).agg(*partials) if group else df.agg(*partials)
        labels = [d.name for d in dims]
        if any(self.own_column(fact, d) is None for d in dims):
            out = self._joined(conformed, fact, out, dims)
            out = out.groupBy(*labels, *(["__at"] if last_over else [])).agg(*[c for m in metrics for c in m.merge()])
        if last_over:
            names = [n for m in metrics for n, _ in m.partials()]
            out = out.groupBy(*labels).agg(F.max_by(F.struct(*names), "__at").alias("__last")).select(*labels, "__last.*")
        return out

    def rows(self, conformed, facts: Sequence[str], dimensions: Sequence[str] = (), where: Sequence[Filter] = (),
             period: tuple[str, str] | None = None, as_of: dt.date = DEFAULT_AS_OF, role: str | None = None,
             scope: DataFrame | None = None) -> DataFrame:
        """Facts row by row, with dimensions: one row per row of their (one) table, no aggregation.

        Only entities of which a dimension other than the key is asked for are
        joined; all others are eliminated, and the scan reads the named columns.
        ``where`` takes facts as well as dimensions; ``period``: (anchor
        dimension, name of the period). Row scope and masks of ``role`` hold."""
        fs = [self.fact(f) for f in facts]
        tables = {f.entity for f in fs}
        if len(tables) != 1:
            raise SemanticError(f"facts of one table can be listed together, not of {sorted(tables)}")
        home = tables.pop()
        dims = [self.dimension(d) for d in dimensions]
        filters = list(where)
        if period:
            filters.append((period[0], "range", period_bounds(period[1], as_of)))
        df = self._fact_frame(conformed, home, filters, role, scope)
        df = df.select(*self._keys(home, dims), *[F.col(f.column).alias(f.name) for f in fs])
        return self._joined(conformed, home, df, dims).select(*[d.name for d in dims], *[f.name for f in fs])

    def query(self, conformed, metrics: Sequence[str], dimensions: Sequence[str] = (),
              where: Sequence[Filter] = (), period: str | None = None, as_of: dt.date = DEFAULT_AS_OF,
              role: str | None = None, scope: DataFrame | None = None, latest_snapshot_default: bool = True,
              order_by: Sequence[str] | None = None) -> DataFrame:
        """Metrics x dimensions x filters, one row per dimension combination.

        ``where`` items are (dimension, op, value) with op in == != < <= > >= in
        between (closed) range (half-open [lo, hi)). ``period='last_quarter'``
        filters each metric's time anchor to the last complete quarter. With no
        snapshot filter or dimension, inventory metrics use the latest snapshot;
        where a group holds several snapshots, its own last one counts (a plant
        that lacks a snapshot is taken at its last; in a group of several plants
        those without the group's last snapshot have no stock in it). A date
        dimension has grains: ``snapshot_date.quarter``.
        Metrics of several facts are aggregated per fact, and the groups united
        by dimension values, NULL included (each dimension must be reachable from
        every fact)."""
        ms = [self.metric(m) for m in metrics]
        facts = list(dict.fromkeys(m.entity for m in ms))
        dims = [self.dimension(d) for d in dimensions]
        parts = []
        for fact in facts:
            fm = [m for m in ms if m.entity == fact]
            filters = list(where)
            if period:
                anchors = {m.anchor for m in fm if m.anchor}
                if len(anchors) != 1:
                    raise SemanticError(f"period needs one time anchor per fact, got {sorted(map(str, anchors))}")
                lo, hi = period_bounds(period, as_of)
                filters.append((anchors.pop(), "range", (lo, hi)))
            fdims = [self.attribute(f[0]) for f in filters]
            for d in [*dims, *fdims]:  # must be reachable from this fact
                self.own_column(fact, d)
            dated = [d for d in dims + fdims if d.entity == fact and d.column in ("snapshot_date", "snapshot_month", "is_latest_snapshot")]
            latest = ("is_latest_snapshot", "==", True)
            if fact == "inventory" and latest_snapshot_default and not dated:
                filters.append(latest)
            over = {m.last_over for m in fm if m.last_over}
            if latest in [tuple(f) for f in filters] or any(d.entity == fact and d.column in over and not d.grain for d in dims):
                over = set()  # one date per group anyway
            if len(over) > 1 or (over and any(not m.last_over for m in fm)):
                raise SemanticError("metrics that add up over time and ones that don't can't be asked for together")
            df = self._fact_frame(conformed, fact, filters, role, scope)
            g = self._aggregate(conformed, fact, df, dims, fm, over.pop() if over else None)
            parts.append(g.select(*[d.name for d in dims], *[m.final().alias(m.name) for m in fm]))
        out = parts[0]
        if dims and len(parts) > 1:
            # one row per fact and group: union and regroup, as grouping treats NULL as a value and a join wouldn't
            for p in parts[1:]:
                out = out.unionByName(p, allowMissingColumns=True)
            out = out.groupBy(*[d.name for d in dims]).agg(*[F.max(m.name).alias(m.name) for m in ms])
        else:
            for p in parts[1:]:  # one-row frames
                out = out.crossJoin(p)
        out = out.select(*[d.name for d in dims], *[m.name for m in ms])
        if order_by:
            out = out.orderBy(*order_by)
        return out

    # -------------------------------------------------------------- metadata
    def describe(self, spark) -> DataFrame:
        rows = [("entity", e.name, e.table, e.pk, ", ".join(e.synonyms), e.comment) for e in self.entities]
        rows += [("relationship", r.name, f"{r.src}({r.fk})", r.dst, "", "") for r in self.relationships]
        rows += [("fact", f"{f.entity}.{f.name}", f.column, f.entity, "", "") for f in self.facts]
        rows += [("dimension", f"{d.entity}.{d.name}", d.column, d.entity, ", ".join(d.synonyms), d.comment)
                 for d in self.dimensions]
        rows += [("metric", f"{m.entity}.{m.name}", _formula(m), m.anchor or "", ", ".join(m.synonyms), m.comment)
                 for m in self.metrics]
        return spark.createDataFrame(rows, "kind string, name string, expression string, target string, "
                                           "synonyms string, comment string")

    def glossary(self, spark) -> DataFrame:
        """term -> (kind, target) for every name and synonym (lower case)."""
        rows = []
        for e in self.entities:
            rows += [(s.lower(), "entity", e.name) for s in (e.name,) + e.synonyms]
        for d in self.dimensions:
            rows += [(s.lower(), "dimension", d.name) for s in (d.name,) + d.synonyms]
        for m in self.metrics:
            rows += [(s.lower(), "metric", m.name) for s in (m.name,) + m.synonyms]
        rows += [(t, "ambiguous", "supplier_otd|customer_otd") for t in AMBIGUOUS_TERMS]
        return spark.createDataFrame(sorted(set(rows)), "term string, kind string, target string")


def _formula(m: Metric) -> str:
    if m.kind == "sum":
        return f"SUM({m.num})"
    if m.kind == "avg":
        return f"AVG({m.num})"
    return f"SUM({m.num}) / NULLIF(SUM({m.den}), 0)"


def _predicate(col: str | Column, op: str, value) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    if op == "==":
        return c == F.lit(value)
    if op == "!=":
        return c != F.lit(value)
    if op == "<":
        return c < F.lit(value)
    if op == "<=":
        return c <= F.lit(value)
    if op == ">":
        return c > F.lit(value)
    if op == ">=":
        return c >= F.lit(value)
    if op == "in":
        return c.isin(list(value))
    if op == "between":
        return c.between(F.lit(value[0]), F.lit(value[1]))
    if op == "range":
        return (c >= F.lit(value[0])) & (c < F.lit(value[1]))
    raise SemanticError(f"unknown operator {op!r}")


def metric_names(model: SemanticModel | None = None) -> list[str]:
    return [m.name for m in (model or SemanticModel()).metrics]

