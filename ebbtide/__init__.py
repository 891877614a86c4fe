"""ebbtide: customer-attrition analytics as Spark jobs."""
