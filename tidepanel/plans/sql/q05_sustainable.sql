-- Labelled rows ordered by label, country, year.
SELECT country, country_code, year, sustainability_label, tourist_arrivals, co2_per_tourist,
       arrivals_growth_pct AS arrivals_growth, co2_growth_pct AS co2_growth
FROM fact_tourism_emissions
WHERE sustainability_label IS NOT NULL AND year >= {min_year}
ORDER BY sustainability_label, country, year
