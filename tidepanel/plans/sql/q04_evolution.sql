-- Per-row evolution of arrivals and emissions.
SELECT year, country, country_code, tourist_arrivals,
       arrivals_growth_pct AS arrivals_growth,
       co2, co2_growth_pct AS co2_growth, co2_per_tourist
FROM fact_tourism_emissions
WHERE year >= {min_year} AND tourist_arrivals IS NOT NULL AND co2 IS NOT NULL
ORDER BY country, year
