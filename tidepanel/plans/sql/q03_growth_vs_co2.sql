-- Mean GDP growth, emission intensity, per-capita emissions and GDP by country.
SELECT country, country_code,
       CAST(SUM(CAST(gdp_growth_pct AS DECIMAL(38,10))) AS DOUBLE) / COUNT(gdp_growth_pct) AS avg_gdp_growth,
       CAST(SUM(CAST(co2_intensity_gdp AS DECIMAL(38,10))) AS DOUBLE) / COUNT(co2_intensity_gdp) AS avg_co2_intensity,
       CAST(SUM(CAST(co2_per_capita_calc AS DECIMAL(38,10))) AS DOUBLE) / COUNT(co2_per_capita_calc) AS avg_co2_per_capita,
       CAST(SUM(CAST(gdp_per_capita AS DECIMAL(38,10))) AS DOUBLE) / COUNT(gdp_per_capita) AS avg_gdp_per_capita
FROM fact_tourism_emissions
WHERE gdp_growth_pct IS NOT NULL AND co2_intensity_gdp IS NOT NULL AND year >= {min_year}
GROUP BY country, country_code
ORDER BY avg_gdp_growth DESC NULLS LAST, avg_co2_intensity ASC NULLS LAST
