SELECT date, campaign_id, campaign_name, device, cost, impressions, clicks
FROM {campaigns}
WHERE date BETWEEN to_date(:start) AND to_date(:end)
