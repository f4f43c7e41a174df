-- Yearly totals of arrivals and emissions (exact decimal sum for emissions).
SELECT year,
       SUM(tourist_arrivals) AS total_arrivals,
       CAST(SUM(CAST(co2 AS DECIMAL(38,10))) AS DOUBLE) AS total_co2
FROM fact_tourism_emissions
WHERE year >= {min_year}
GROUP BY year
ORDER BY year
