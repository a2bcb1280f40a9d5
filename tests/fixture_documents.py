"""Documents with nulls, absences and values of several types under one path."""

SHIPMENTS = [
    '{"id":"a","port":"oslo","vessel":"North Star","tons":55,"stops":["hull","bergen"]}',
    '{"id":"b","port":"oslo","vessel":"Grey Heron","tons":410,"broker":{"code":"K-7"}}',
    '{"id":"c","port":"riga","vessel":"Amber","tons":90}',
    '{"id":"d","port":"riga","vessel":"Old Swan","tons":null}',
    '{"id":"e","port":"riga","vessel":"Stork"}',
    '{"id":"f","port":null,"vessel":"Drifter","tons":4}',
    '{"id":"g","vessel":"Nobody","tons":12}',
    '{"id":"h","port":7,"vessel":"Skua","tons":"90"}',
]
READINGS = [
    '{"id":"m","site":"x","kind":"Plain","value":12,"flag":"lamp","at":"2024-02-29T10:20:30Z"}',
    '{"id":"n","site":"x","kind":"Text","value":"12","flag":12}',
    '{"id":"o","site":"x","kind":"Broken","value":12.9,"flag":false}',
    '{"id":"p","site":"x","kind":"Gone","flag":["lamp"]}',
    '{"id":"q","site":"x","kind":"Void","value":null,"flag":{"of":"lamp"}}',
    '{"id":"r","site":"y","kind":"Other","value":3,"flag":null}',
    '{"id":"s","site":"y","kind":"Bare","value":-4}',
    '{"id":"t","site":"12","kind":"Digits","value":5,"flag":"door"}',
    '{"id":"u","site":"x","kind":"Vast","value":5,"flag":"vast","mass":-4e33}',
]
