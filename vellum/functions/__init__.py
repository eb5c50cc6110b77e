from vellum.functions.paths import file_name, is_pdf, pdf_id, product_id
from vellum.functions.numbers import try_to_number
from vellum.functions.semi import json_path_text
from vellum.functions.geo import st_point, point_wkt

__all__ = ["file_name", "is_pdf", "pdf_id", "product_id", "try_to_number",
           "json_path_text", "st_point", "point_wkt"]
