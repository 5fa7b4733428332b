"""Column layout of the source files.

Fixed values: file names, table names, column names and types of the six sources.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Source:
    """A source file: which system it comes from, its name there, its bronze table and its columns."""

    system: str
    file: str
    table: str
    schema: str


SOURCES = (
    Source(
        "crm", "cust_info.csv", "crm_cust_info",
        "cst_id INT, cst_key STRING, cst_firstname STRING, cst_lastname STRING, cst_marital_status STRING,"
        " cst_gndr STRING, cst_create_date DATE",
    ),
    Source(
        "crm", "prd_info.csv", "crm_prd_info",
        "prd_id INT, prd_key STRING, prd_nm STRING, prd_cost INT, prd_line STRING, prd_start_dt DATE,"
        " prd_end_dt DATE",
    ),
    Source(
        "crm", "sales_details.csv", "crm_sales_details",
        "sls_ord_num STRING, sls_prd_key STRING, sls_cust_id INT, sls_order_dt INT, sls_ship_dt INT,"
        " sls_due_dt INT, sls_sales INT, sls_quantity INT, sls_price INT",
    ),
    Source("erp", "CUST_AZ12.csv", "erp_cust_az12", "CID STRING, BDATE DATE, GEN STRING"),
    Source("erp", "LOC_A101.csv", "erp_loc_a101", "CID STRING, CNTRY STRING"),
    Source("erp", "PX_CAT_G1V2.csv", "erp_px_cat_g1v2", "ID STRING, CAT STRING, SUBCAT STRING, MAINTENANCE STRING"),
)


def source(table: str) -> Source:
    return next(s for s in SOURCES if s.table == table)
