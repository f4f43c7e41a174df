-- Rows and mean co2-per-tourist / mode shares by dominant transport mode.
SELECT dominant_transport,
       COUNT(*) AS n_rows,
       CAST(SUM(CAST(co2_per_tourist AS DECIMAL(38,10))) AS DOUBLE) / COUNT(co2_per_tourist) AS avg_co2_per_tourist,
       CAST(SUM(CAST(pct_air AS DECIMAL(38,10))) AS DOUBLE) / COUNT(pct_air) AS avg_pct_air,
       CAST(SUM(CAST(pct_sea AS DECIMAL(38,10))) AS DOUBLE) / COUNT(pct_sea) AS avg_pct_sea,
       CAST(SUM(CAST(pct_land AS DECIMAL(38,10))) AS DOUBLE) / COUNT(pct_land) AS avg_pct_land
FROM fact_tourism_emissions
WHERE dominant_transport IS NOT NULL AND co2_per_tourist IS NOT NULL
GROUP BY dominant_transport
ORDER BY avg_co2_per_tourist DESC NULLS LAST
