"""Twins of the sales, inventory, service, customer and reporting views."""

from __future__ import annotations

from forecourt.oracle.base import big, build, day, flag, half_up, instant, money, percent, ratio, ymd

SALES_SUMS = f"""{big('sum(units)')} AS units_sold, {money('sum(rev_c)')} AS revenue,
  {money('sum(gp_c)')} AS gross_profit, {percent('sum(gp_c)', 'sum(rev_c)')} AS gross_margin_percent,
  {ratio('sum(rev_c)', 'sum(units)')} AS average_selling_price, count(*) AS fact_row_count,
  count(DISTINCT sale_id) AS distinct_sale_count"""

STOCK_SUMS = f"""{big('sum(units)')} AS inventory_units, {money('sum(value_c)')} AS inventory_value,
  {ratio('100 * sum(days * units)', 'sum(units)')} AS average_age_days, count(*) AS fact_row_count,
  count(DISTINCT (inventory_id, snap)) AS distinct_inventory_count"""

SLOW_SUMS = f"""{big('coalesce(sum(units) FILTER (slow), 0)')} AS slow_moving_units,
  {money('coalesce(sum(value_c) FILTER (slow), 0)')} AS slow_moving_value"""

VISIT_SUMS = f"""count(*) AS appointments, {big('sum(done)')} AS completed_appointments,
  {big('sum(cancelled)')} AS cancellations, {big('sum(missed)')} AS no_shows,
  {percent('sum(done)', 'sum(eligible)')} AS completion_rate_percent, count(service_order_id) AS repair_orders,
  {money('sum(revenue_c)')} AS service_revenue, NULL::DOUBLE AS service_cost, NULL::DOUBLE AS service_profit,
  {ratio('sum(revenue_c)', 'count(service_order_id)')} AS average_repair_order, count(*) AS detail_row_count,
  count(DISTINCT appointment_id) AS distinct_appointment_count"""

SNAP = f"snap AS snapshot_date_key, {day('snapshot_date')} AS snapshot_date"
DEALER = "dealership_key, dealership_id, dealership_name"
CAR = f"vehicle_key, vehicle_id, vin, brand, model, {big('model_year')} AS model_year, vehicle_type, fuel_type, vehicle_condition"

BUYER_SUMS = f"""{money('sum(service_c)')} AS service_revenue, {money('sum(value_c)')} AS customer_revenue,
  {big('sum(orders_n)')} AS service_orders,
  {ratio('sum(per_year_c)', 'count(per_year_c)')} AS average_service_frequency_per_year,
  count(DISTINCT customer_key) AS distinct_customer_count"""


def _q(sql: str) -> str:
    return build(sql.strip())


def _calendar(prefix: str = "") -> str:
    year, quarter = (f"{prefix}year", f"{prefix}quarter") if prefix else ("calendar_year", "quarter_number")
    return (f"{big('y')} AS {year}, {big('q')} AS {quarter}, {big('m')} AS {prefix}month_number, "
            f"month_name AS {prefix}month_name")


SALE_TAIL = f"""salesperson_id, salesperson_name, sales_channel, payment_type, sale_status,
  {big('units')} AS units_sold, {money('list_c')} AS list_price, {money('discount_c')} AS discount_amount,
  {money('rev_c')} AS revenue, {money('cost_c')} AS vehicle_cost, {money('gp_c')} AS gross_profit"""

STOCK_TAIL = f"""{day('acquired_date')} AS acquired_date, inventory_status, {big('units')} AS inventory_units,
  {money('value_c')} AS inventory_value, {big('days')} AS days_in_inventory, bucket AS aging_bucket,
  {big('bucket_no')} AS aging_bucket_sort"""

VISIT_FLAGS = f"""1::BIGINT AS appointment_count, {big('done')} AS completed_appointment_count,
  {big('cancelled')} AS cancellation_count, {big('missed')} AS no_show_count,
  {big('eligible')} AS completion_eligible_count"""

VISIT_MONEY = f"""{flag('on_time')} AS completed_on_time, {money('hours_c')} AS turnaround_hours,
  {money('labor_c')} AS labor_revenue, {money('parts_c')} AS parts_revenue, {money('discount_c')} AS discount_amount,
  {money('revenue_c')} AS service_revenue, NULL::DOUBLE AS service_cost, NULL::DOUBLE AS service_profit,
  'false' AS service_cost_available"""

CUSTOMER_TAIL = f"""customer_type, {day('customer_since_date')} AS customer_since_date, {day('as_of')} AS as_of_date,
  {big('sales_n')} AS sales_transaction_count, {big('net_units')} AS net_units_purchased,
  {money('sales_c')} AS sales_revenue, {day('first_sale')} AS first_sale_date, {day('last_sale')} AS last_sale_date,
  {big('orders_n')} AS service_order_count, {money('service_c')} AS service_revenue,
  {day('first_service')} AS first_service_date, {day('last_service')} AS last_service_date,
  {big('touches')} AS qualifying_interaction_count, {day('first_act')} AS first_activity_date,
  {day('last_act')} AS last_activity_date, {money('value_c')} AS customer_revenue,
  {money('value_c')} AS customer_lifetime_value, 'Revenue-based interim CLV' AS clv_method,
  relationship_segment, lifecycle_segment, activity_segment, service_frequency_segment,
  {money('per_year_c')} AS service_frequency_per_year, {money('gap_c')} AS average_days_between_services"""


def _sales_group(keys: str, extra: str = "") -> str:
    return _q(f"SELECT {keys}, {extra} {SALES_SUMS} FROM sd GROUP BY ALL")


def _scorecard() -> str:
    return _q(f"""
SELECT d.dealership_id, d.dealership_name, d.city, d.state, d.postal_code, d.region,
  {big('coalesce(s.u, 0)')} AS units_sold, {money('coalesce(s.r, 0)')} AS sales_revenue,
  {money('coalesce(s.g, 0)')} AS sales_gross_profit, {percent('s.g', 's.r')} AS sales_gross_margin_percent,
  {ratio('s.r', 's.u')} AS average_selling_price, {big('coalesce(s.n, 0)')} AS sales_fact_rows,
  {day('i.snapshot_date')} AS inventory_snapshot_date, {big('coalesce(i.u, 0)')} AS inventory_units,
  {money('coalesce(i.v, 0)')} AS inventory_value, {ratio('100 * i.age', 'i.u')} AS average_inventory_age_days,
  {big('coalesce(i.su, 0)')} AS slow_moving_units, {money('coalesce(i.sv, 0)')} AS slow_moving_value,
  {big('coalesce(v.n, 0)')} AS appointments, {big('coalesce(v.done, 0)')} AS completed_appointments,
  {big('coalesce(v.cancelled, 0)')} AS cancellations, {big('coalesce(v.missed, 0)')} AS no_shows,
  {percent('v.done', 'v.eligible')} AS service_completion_rate_percent, {big('coalesce(v.o, 0)')} AS repair_orders,
  {money('coalesce(v.r, 0)')} AS service_revenue, {ratio('v.r', 'v.o')} AS average_repair_order,
  {big('coalesce(v.n, 0)')} AS service_detail_rows, {big('coalesce(c.n, 0)')} AS unique_customers,
  {money('coalesce(s.r, 0) + coalesce(v.r, 0)')} AS total_revenue
FROM dealers d
LEFT JOIN (SELECT dealership_key, sum(units) AS u, sum(rev_c) AS r, sum(gp_c) AS g, count(*) AS n
           FROM sd GROUP BY 1) s USING (dealership_key)
LEFT JOIN (SELECT dealership_key, max(snapshot_date) AS snapshot_date, sum(units) AS u, sum(value_c) AS v,
             sum(days * units) AS age, sum(units) FILTER (slow) AS su, sum(value_c) FILTER (slow) AS sv
           FROM idt WHERE snap = (SELECT max(snap) FROM idt) GROUP BY 1) i USING (dealership_key)
LEFT JOIN (SELECT dealership_key, count(*) AS n, sum(done) AS done, sum(cancelled) AS cancelled,
             sum(missed) AS missed, sum(eligible) AS eligible, count(service_order_id) AS o, sum(revenue_c) AS r
           FROM vd GROUP BY 1) v USING (dealership_key)
LEFT JOIN (SELECT dealership_key, count(DISTINCT customer_key) AS n
           FROM (SELECT dealership_key, customer_key FROM sd UNION ALL SELECT dealership_key, customer_key FROM vd)
           GROUP BY 1) c USING (dealership_key)""")


SQL: dict[str, str] = {
    "v_sal_1_sales_detail": _q(f"""
SELECT sale_no AS sales_key, sale_id, {ymd('sale_date')} AS sale_date_key, {day('sale_date')} AS sale_date,
  {_calendar()}, customer_key, {CAR}, {DEALER}, region, state, salesperson_key, {SALE_TAIL} FROM sd"""),
    "v_sal_2_sales_kpis": _q(f"SELECT {SALES_SUMS} FROM sd"),
    "v_sal_3_monthly_sales": _sales_group(
        f"{big('y')} AS calendar_year, {big('m')} AS month_number, month_name",
        f"{day('min(sale_date)')} AS month_start_date,"),
    "v_sal_4_brand_model_performance": _sales_group(f"brand, model, {big('model_year')} AS model_year"),
    "v_sal_5_salesperson_performance": _sales_group(f"salesperson_key, salesperson_id, salesperson_name, {DEALER}"),
    "v_sal_6_dealership_performance": _sales_group(f"{DEALER}, region, state"),
    "v_sal_7_vehicle_type_performance": _sales_group("vehicle_type, vehicle_condition, fuel_type"),
    "v_sal_8_payment_method_performance": _sales_group("payment_type"),
    "v_inv_1_inventory_detail": _q(f"""
SELECT (substr(inventory_id, 4)::HUGEINT * 100000000 + snap)::DOUBLE AS inventory_key, inventory_id, {SNAP}, {CAR},
  {DEALER}, region, state, {STOCK_TAIL}, {flag('slow')} AS is_slow_moving FROM idt"""),
    "v_inv_2_inventory_kpis": _q(f"""
SELECT {SNAP}, {big('sum(days * units)')} AS total_inventory_days, {STOCK_SUMS}, {SLOW_SUMS} FROM idt GROUP BY ALL"""),
    "v_inv_3_aging_buckets": _q(f"""
SELECT {SNAP}, bucket AS aging_bucket, {big('bucket_no')} AS aging_bucket_sort, {STOCK_SUMS} FROM idt GROUP BY ALL"""),
    "v_inv_4_brand_model_inventory": _q(f"""
SELECT {SNAP}, brand, model, {big('model_year')} AS model_year, {STOCK_SUMS}, {SLOW_SUMS} FROM idt GROUP BY ALL"""),
    "v_inv_5_dealership_inventory": _q(f"""
SELECT {SNAP}, {DEALER}, region, state, {STOCK_SUMS}, {SLOW_SUMS} FROM idt GROUP BY ALL"""),
    "v_inv_6_slow_moving_vehicles": _q(f"""
SELECT (substr(inventory_id, 4)::HUGEINT * 100000000 + snap)::DOUBLE AS inventory_key, inventory_id, {SNAP}, {CAR},
  {DEALER}, region, state, {STOCK_TAIL} FROM idt WHERE days > 90"""),
    "v_svc_1_appointment_detail": _q(f"""
SELECT appointment_id, {ymd('appointment_date')} AS appointment_date_key, {day('appointment_date')} AS appointment_date,
  {_calendar()}, appointment_time, customer_key, customer_id, vehicle_key, vehicle_id, vin, brand AS vehicle_brand,
  model AS vehicle_model, {DEALER}, region, state, service_advisor_key, service_advisor_id, service_advisor_name,
  service_key, service_type, service_category, appointment_status, {VISIT_FLAGS},
  CASE WHEN service_order_id IS NOT NULL THEN visit_no END AS service_fact_key, service_order_id,
  CASE WHEN service_order_id IS NOT NULL THEN 1::BIGINT END AS repair_order_quantity, technician_key, technician_id,
  technician_name, payer_type, {instant('opened_at')} AS opened_at, {instant('promised_at')} AS promised_at,
  {instant('completed_at')} AS completed_at, {VISIT_MONEY} FROM vd"""),
    "v_svc_2_service_kpis": _q(f"SELECT {VISIT_SUMS}, 'false' AS service_cost_available FROM vd"),
    "v_svc_3_monthly_service": _q(f"""
SELECT {big('y')} AS calendar_year, {big('m')} AS month_number, month_name,
  {day('min(appointment_date)')} AS month_start_date, {VISIT_SUMS} FROM vd GROUP BY ALL"""),
    "v_svc_4_service_type_performance": _q(f"""
SELECT service_key, service_type, service_category, {VISIT_SUMS} FROM vd GROUP BY ALL"""),
    "v_svc_5_dealership_service": _q(f"SELECT {DEALER}, region, state, {VISIT_SUMS} FROM vd GROUP BY ALL"),
    "v_svc_6_technician_performance": _q(f"""
SELECT technician_key, technician_id, technician_name, {DEALER}, count(service_order_id) AS repair_orders,
  {money('sum(revenue_c)')} AS service_revenue, NULL::DOUBLE AS service_cost, NULL::DOUBLE AS service_profit,
  {ratio('sum(revenue_c)', 'count(service_order_id)')} AS average_repair_order,
  {ratio('sum(hours_c)', 'count(hours_c)')} AS average_turnaround_hours,
  {percent('count(*) FILTER (on_time)', 'count(service_order_id)')} AS on_time_completion_rate_percent,
  count(*) AS detail_row_count, count(DISTINCT service_order_id) AS distinct_service_order_count
FROM vd WHERE service_order_id IS NOT NULL GROUP BY ALL"""),
    "v_cus_1a_sales_by_customer": _q(f"""
SELECT customer_key, {big('n')} AS sales_transaction_count, {big('units')} AS net_units_purchased,
  {money('rev_c')} AS sales_revenue, {day('first_d')} AS first_sale_date, {day('last_d')} AS last_sale_date
FROM buyer_sales"""),
    "v_cus_1b_service_by_customer": _q(f"""
SELECT customer_key, {big('n')} AS service_order_count, {money('rev_c')} AS service_revenue,
  {day('first_d')} AS first_service_date, {day('last_d')} AS last_service_date FROM buyer_service"""),
    "v_cus_1c_warehouse_as_of": _q(f"SELECT {day('d')} AS as_of_date FROM today"),
    "v_cus_1_lifetime_detail": _q(f"""
SELECT customer_key, customer_id, first_name || ' ' || last_name AS customer_name, email, phone, city, state,
  postal_code, {CUSTOMER_TAIL} FROM cd"""),
    "v_cus_2_customer_kpis": _q(f"""
SELECT count(*) AS total_customers, count(*) FILTER (touches > 0) AS active_lifetime_customers,
  count(*) FILTER (touches = 1) AS new_customers, count(*) FILTER (touches > 1) AS repeat_customers,
  {percent('count(*) FILTER (touches > 1)', 'count(*) FILTER (touches > 0)')} AS repeat_rate_percent,
  count(*) FILTER (relationship_segment = 'Sales Only') AS sales_only_customers,
  count(*) FILTER (relationship_segment = 'Service Only') AS service_only_customers,
  count(*) FILTER (relationship_segment = 'Sales + Service') AS sales_and_service_customers,
  count(*) FILTER (activity_segment = 'Inactive') AS inactive_customers,
  count(*) FILTER (activity_segment = 'Never Active') AS never_active_customers,
  {money('sum(sales_c)')} AS sales_revenue, {money('sum(value_c)')} AS total_customer_lifetime_value,
  {ratio('sum(value_c)', 'count(*)')} AS average_customer_lifetime_value, {BUYER_SUMS} FROM cd"""),
    "v_cus_3_segment_summary": _q(f"""
SELECT relationship_segment, lifecycle_segment, activity_segment, count(*) AS customers,
  {big('sum(sales_n)')} AS sales_transactions, {money('sum(sales_c)')} AS sales_revenue,
  {money('sum(value_c)')} AS customer_lifetime_value,
  {ratio('sum(value_c)', 'count(*)')} AS average_customer_lifetime_value, {BUYER_SUMS} FROM cd GROUP BY ALL"""),
    "v_cus_4_service_frequency": _q(f"""
SELECT service_frequency_segment, {big('freq_no')} AS service_frequency_sort, count(*) AS customers,
  {ratio('sum(gap_c)', 'count(gap_c)')} AS average_days_between_services, {BUYER_SUMS} FROM cd GROUP BY ALL"""),
    "v_rep_1_sales_performance": _q(f"""
SELECT sale_id, {day('sale_date')} AS sale_date, {_calendar('sale_')}, customer_key,
  {CAR.removeprefix('vehicle_key, ')}, {DEALER.removeprefix('dealership_key, ')}, region, state, {SALE_TAIL},
  {percent('gp_c', 'rev_c')} AS gross_margin_percent, {ratio('rev_c', 'units')} AS average_selling_price FROM sd"""),
    "v_rep_2_inventory_aging": _q(f"""
SELECT inventory_id, {day('snapshot_date')} AS snapshot_date, {CAR.removeprefix('vehicle_key, ')},
  {DEALER.removeprefix('dealership_key, ')}, region, state, {STOCK_TAIL}, {flag('slow')} AS is_slow_moving FROM idt"""),
    "v_rep_3_service_performance": _q(f"""
SELECT appointment_id, {day('appointment_date')} AS appointment_date, {_calendar('appointment_')}, appointment_time,
  customer_key, vehicle_id, vin, brand AS vehicle_brand, model AS vehicle_model,
  {DEALER.removeprefix('dealership_key, ')}, region, state, service_advisor_id, service_advisor_name, service_type,
  service_category, appointment_status, {VISIT_FLAGS}, service_order_id, technician_id, technician_name, payer_type,
  {VISIT_MONEY} FROM vd"""),
    "v_rep_4_customer_value": _q(f"""
SELECT customer_id, first_name || ' ' || last_name AS customer_name, city, state, postal_code, {CUSTOMER_TAIL}
FROM cd"""),
    "v_rep_5_dealership_performance": _scorecard(),
}
